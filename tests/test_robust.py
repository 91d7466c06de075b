"""Inputs that used to change results: ties, offsets, null keys, null runs, small tables."""
import numpy as np
import pandas as pd
import pytest

from sparkfeat.operators import compress as C
from sparkfeat.operators import knn as K
from sparkfeat.operators import models as M
from sparkfeat.operators import outliers as O
from sparkfeat.operators import profile as P
from sparkfeat.operators import rolling as R
from sparkfeat.operators import split as L
from sparkfeat.operators.isoforest import IsolationForest, c_factor, descent_table, path_lengths
from sparkfeat.operators.ranks import wide_select


def knn_by_hand(T, Q, k):
    d = np.sqrt(((Q[:, None, :] - T[None]) ** 2).sum(2))
    return [[int(j) for j in np.lexsort((np.arange(len(T)), row))[:k]] for row in d]


@pytest.mark.parametrize("blocks", [(20_000, 2_000), (100, 7)])
@pytest.mark.parametrize("kind", ["ties", "offset", "plain"])
def test_knn_is_exact(spark, kind, blocks):
    r = np.random.default_rng(4)
    T = np.ones((400, 3)) if kind == "ties" else r.normal(size=(400, 3))
    if kind == "offset":
        T = 1e6 + T * 1e-3
    Q = T[:20] + (0 if kind == "ties" else 1e-5)
    ref = spark.createDataFrame([(i, int(i % 3), x.tolist()) for i, x in enumerate(T)], "id long, label int, features array<double>")
    qry = spark.createDataFrame([(i, 0, x.tolist()) for i, x in enumerate(Q)], "id long, label int, features array<double>")
    got = K.neighbours(ref, qry, 5, ref_block=blocks[0], query_block=blocks[1]).collect()
    by = {q: [r["cid"] for r in sorted(got, key=lambda r: r["rank"]) if r["qid"] == q] for q in range(20)}
    assert [by[q] for q in range(20)] == knn_by_hand(T, Q, 5)


def keyed(spark):
    return spark.createDataFrame([(i, float(i % 13), None if i % 4 == 0 else f"k{i % 3}") for i in range(100)],
                                 "id long, x double, k string")


def test_null_keys_are_a_key(spark):
    df = keyed(spark)
    assert L.stratified_folds(df, "k", "id", 5).groupBy("k").count().collect().__len__() == 4
    assert L.stratified_folds(df, "k", "id", 5).count() == 100
    split = L.stratified_split(df, "k", "id", 0.2)
    assert split.count() == 100 and split.where("split = 'test'").count() == 20
    assert L.stratified_subset(df, "k", "id", 40).count() == 40
    assert C.prune(df, "x", "k", 0.5).count() == 100
    assert R.sign_changes(df, "x", ["id"], partition_by="k").count() == 100
    rolled = R.rolling(df, ["x"], ["id"], [3], partition_by="k").toPandas().sort_values("id")
    own = rolled[rolled["k"].isna()]
    assert np.allclose(own["x_MA_3"].to_numpy()[2:], own["x"].rolling(3).mean().to_numpy()[2:])


def test_pruning_ties_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i, 0.5) for i in range(300)], "id long, w double")
    a, b = (sorted(r["id"] for r in C.prune(df.repartition(n), "w", None, 0.7).where("w = 0").collect()) for n in (2, 9))
    assert a == b and len(a) == 210


@pytest.mark.parametrize("chunk", [None, 250])
def test_ema_over_a_long_null_run(spark, chunk):
    x = np.array([2.0, 2.2] + [np.nan] * 6000 + [5.0, np.nan, 6.0])
    rows = [(i, None if np.isnan(v) else float(v)) for i, v in enumerate(x)]
    got = R.ema(spark.createDataFrame(rows, "t long, x double"), ["x"], ["t"], [10], chunk=chunk).toPandas().sort_values("t")
    want = pd.Series(x).ewm(span=10).mean().to_numpy()
    assert np.allclose(got["x_EMA_10"].to_numpy()[:3000], want[:3000]) and not got["x_EMA_10"].isna().any()
    assert np.allclose(got["x_EMA_10"].to_numpy()[2:6002], got["x_EMA_10"].to_numpy()[1])
    assert np.allclose(got["x_EMA_10"].to_numpy()[6002:], pd.Series([5.0, np.nan, 6.0]).ewm(span=10).mean())


def test_forest_draws_whole_samples_from_small_tables(spark):
    r = np.random.default_rng(0)
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(r.normal(size=(1000, 2)))], "id long, a double, b double")
    one, two = (IsolationForest(["a", "b"], trees=30).fit(df.repartition(n)) for n in (2, 7))
    assert one.psi == 256
    # the path-length credit of a root is that of its number of rows
    assert len(one.forest) == 30 and all(t[4][0] == c_factor(256) for t in one.forest)
    assert all((a[0] == b[0]).all() and np.allclose(a[1], b[1]) for a, b in zip(one.forest, two.forest))


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (9.0, 5.0, None), (2.0, 5.0, None)], "a double, c double, e double")
    z = O.zscore_outliers(df, ["a", "c", "e"]).toPandas()
    assert z["max_abs_z"].max() < 2 and not z["is_outlier"].any()
    assert not O.zscore_outliers(df, ["c"]).toPandas()["is_outlier"].any()
    counts = {r["column"]: r["n_outliers"] for r in P.iqr_counts(df, ["a", "e"]).collect()}
    assert counts == {"a": 0, "e": 0} and P.iqr_rows(df, ["a", "e"]).count() == 0
    with pytest.raises(ValueError):
        C.calibrate(df, ["e"])


@pytest.mark.parametrize("kind", ["normal", "ties", "spread"])
def test_ranks_by_brackets(spark, kind):
    r = np.random.default_rng(8)
    x = {"normal": r.normal(size=4000), "ties": r.integers(0, 5, 4000).astype(float),
         "spread": np.concatenate([np.full(1500, -0.0), 10.0 ** r.uniform(-300, 300, 2490), [np.inf, -np.inf] * 5])}[kind]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)] * 10, "x double").repartition(5)
    want = np.sort(x)
    ranks = [0, 1, 1000, 2000, 3999]
    for sample in (100, 10_000):
        got = wide_select(df, {"x": ranks}, {"x": 4000}, sample)
        assert [got[("x", k)] for k in ranks] == [want[k] for k in ranks]


def test_models_learn_and_come_back(spark, tmp_path):
    r = np.random.default_rng(1)
    centres = np.array([[0, 0, 0, 0], [6, 0, 6, 0], [0, 6, 0, 6]])
    rows = [(i, (centres[i % 3] + r.normal(size=4) * 0.5).tolist(), i % 3) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, f array<double>, label int")
    from pyspark.ml import PipelineModel
    for name in ("logistic", "rbf_svm", "naive_bayes", "mlp_small"):
        model, _ = M.fit_model(name, df, "f", "label")
        pred = {x["id"]: x["pred"] for x in M.predict(model, df, "f", "id", "label").collect()}
        assert np.mean([pred[i] == y for i, _, y in rows]) > 0.9, name
        path = str(tmp_path / name)
        model.write().overwrite().save(path)
        again = M.predict(PipelineModel.load(path), df, "f", "id", "label").collect()
        assert {x["id"]: x["pred"] for x in again} == pred, name
        steps = M.history(model)
        if name in ("logistic", "mlp_small"):
            assert len(steps) > 1 and steps[-1] < steps[0]
        else:
            assert steps == []
    assert M.mlp_param_count([4, 16, 8, 3]) == 243 and M.mlp_param_count([4, 64, 32, 16, 3]) == 2979


def test_path_lengths_match_a_descent_by_hand():
    feat, thr = np.array([0, -1, 1, -1, -1]), np.array([0.5, 0.0, 2.0, 0.0, 0.0])
    left, right = np.array([1, -1, 3, -1, -1]), np.array([2, -1, 4, -1, -1])
    adj = np.array([c_factor(n) for n in (9, 3, 6, 1, 5)])
    X = np.array([[0.1, 9.0], [0.5, 1.0], [0.7, 2.0], [np.nan, np.nan]])  # what is not less goes right
    one = descent_table(feat, thr, left, right, adj)
    alone = descent_table(*(np.array(x) for x in ([-1], [0.0], [-1], [-1], [c_factor(4)])))
    want = np.array([1 + c_factor(3), 2 + c_factor(1), 2 + c_factor(5), 2 + c_factor(5)])
    assert np.array_equal(path_lengths([one], X), want)
    assert np.array_equal(path_lengths([one, alone], X), want + c_factor(4))
