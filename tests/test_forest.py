"""Forests: splits against brute force, one forest at any partitioning and for all candidates of a grid."""
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sparkfeat.operators import forest as FO
from sparkfeat.operators import tune as G


def _table(spark, n=900, dims=6, seed=5):
    r = np.random.default_rng(seed)
    X = r.normal(size=(n, dims)).round(2)
    y = (X[:, 0] + X[:, 1] > 0).astype(int) + (X[:, 2] > 0.8) * (r.random(n) < 0.7)
    rows = [(i, X[i].tolist(), float(y[i]), i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "id long, x array<double>, label_d double, fold int").withColumn("features", array_to_vector("x"))


def _forest(**more):
    return FO.Forest(featuresCol="features", labelCol="label_d", seed=42, **more)


def _same(one, two):
    return len(one) == len(two) and all(np.array_equal(x, y) for a, b in zip(one, two) for x, y in zip(a, b))


def _brute(X, y, w, feats, bins):
    def impurity(c):
        return c.sum() - (c * c).sum() / c.sum()
    count = lambda own: np.bincount(y[own], w[own], y.max() + 1)
    best, at = impurity(count(np.ones(len(y), dtype=bool))), None
    for f in feats:
        for t in range(bins - 1):
            left = X[:, f] <= t
            if left.any() and not left.all() and impurity(count(left)) + impurity(count(~left)) < best - 1e-9:
                best, at = impurity(count(left)) + impurity(count(~left)), (f, t)
    return at, best


@pytest.mark.parametrize("n", [40, 4000])  # sparse and dense statistics
def test_splits_are_the_best_of_all(n):
    r = np.random.default_rng(n)
    X, y, w = r.integers(0, 16, (n, 5)).astype(np.uint8), r.integers(0, 4, n), r.integers(1, 400, n)
    g = r.integers(0, 3, n)
    counts = np.bincount(g * 4 + y, w, 12).reshape(3, 4)
    feats = np.array([[0, 3], [4, 1], [2, 0]])
    feature, split = FO.best_splits(X, np.arange(n), g, y, w, counts, feats, 16)
    for node in range(3):
        own = g == node
        at, best = _brute(X[own], y[own], w[own], feats[node], 16)
        got = X[own][:, feature[node]] <= split[node]
        left, right = (np.bincount(y[own][s], w[own][s], 4) for s in (got, ~got))
        assert at is not None and abs(sum(c.sum() - (c * c).sum() / c.sum() for c in (left, right)) - best) < 1e-6 * best


def test_trees_do_not_depend_on_partitions_or_on_where_rows_meet(spark, monkeypatch):
    df = _table(spark)
    df = df.union(df.where("id % 4 = 0"))
    one = _forest(numTrees=4, maxDepth=12).fit(df.repartition(2))
    assert _same(one.own_trees(), _forest(numTrees=4, maxDepth=12).fit(df.repartition(7)).own_trees())
    assert sum(len(t[0]) for t in one.own_trees()) > 100
    monkeypatch.setattr(FO, "LOCAL_VALUES", 6 * 150)  # histograms for the upper levels
    assert _same(one.own_trees(), _forest(numTrees=4, maxDepth=12).fit(df).own_trees())
    monkeypatch.setattr(FO, "LOCAL_VALUES", 6)
    assert _same(_forest(numTrees=2, maxDepth=3).fit(df).own_trees(), [FO.cut(t, 3, 3) for t in one.grown.trees[:2]])


def test_candidates_are_what_each_gets_alone(spark, monkeypatch):
    df, est, grown = _table(spark).cache(), _forest(cacheNodeIds=True), []
    grow = FO.grow_forest
    monkeypatch.setattr(FO, "grow_forest", lambda *a, **b: grown.append(a[3:5]) or grow(*a, **b))
    maps = [{est.numTrees: n, est.maxDepth: d} for n in (2, 5) for d in (3, 9)]
    models = dict(est.fitMultiple(df, maps))
    assert grown == [(5, 9)]  # as many trees and as deep as any candidate: nothing is left out
    for i, p in enumerate(maps):
        alone = est.fit(df, p)
        assert _same(models[i].own_trees(), alone.own_trees()) and models[i].totalNumNodes == alone.totalNumNodes
        assert len(models[i].own_trees()) == p[est.numTrees]
    other = dict(est.fitMultiple(df, [{est.maxBins: 8}, {est.maxBins: 32}]))
    assert not _same(other[0].own_trees(), other[1].own_trees())


def test_the_grid_holds_one_forest_a_fold(spark, monkeypatch):
    """A fit of each candidate kept all its nodes on the driver, eight fits at a time."""
    df, grown = _table(spark, 300), []
    grow = FO.grow_forest
    monkeypatch.setattr(FO, "grow_forest", lambda *a, **b: grown.append(a[3:5]) or grow(*a, **b))
    model, table = G.grid_search(_forest(), {"numTrees": [3, 6], "maxDepth": [2, 8]}, df)
    assert sorted(grown[:3]) == [(6, 8)] * 3 and len(grown) == 4  # three folds and the refit
    rows = table.collect()
    assert len(rows) == 4 and all(0.4 < r["mean_score"] <= 1 for r in rows)
    best = min(rows, key=lambda r: r["rank"])
    assert model.bestModel.trees == int(best["params"].split("numTrees=")[1])


def test_saved_forests_score_the_same(spark, tmp_path):
    df = _table(spark)
    model = _forest(numTrees=7, maxDepth=20).fit(df)
    path = str(tmp_path / "forest")
    PipelineModel(stages=[model]).write().overwrite().save(path)
    cols = ["id", "prediction", "probability", "rawPrediction"]
    was = model.transform(df).select(*cols, "label_d").toPandas().sort_values("id")
    now = PipelineModel.load(path).transform(df).select(*cols).toPandas().sort_values("id")
    assert was["prediction"].tolist() == now["prediction"].tolist() and was["probability"].tolist() == now["probability"].tolist()
    assert (was["prediction"] == was["label_d"]).mean() > 0.95 and np.allclose([sum(v) for v in was["probability"]], 1.0)


def test_copies_are_drawn_for_themselves():
    h = np.random.default_rng(1).integers(-2**62, 2**62, 20_000)
    for c in (1.0, 3.0, 500.0):
        w = FO.bag(FO._root(42, 3), h, np.full(len(h), c))
        assert abs(w.mean() - c) < 0.05 * c and abs(w.var() - c) < 0.05 * c
    assert np.corrcoef(FO.bag(FO._root(42, 0), h, np.ones(len(h))), FO.bag(FO._root(42, 1), h, np.ones(len(h))))[0, 1] < 0.03


def test_a_few_vectors_often(spark):
    """Many copies of few rows: thresholds lie between them, whatever the sample."""
    df = spark.range(0, 30_000).select("id", array_to_vector(F.array(F.col("id") % 5, F.lit(1)).cast("array<double>")).alias("features"),
                                       ((F.col("id") % 5) % 2).cast("double").alias("label_d"))
    model = _forest(numTrees=3, maxDepth=5, featureSubsetStrategy="all").fit(df)
    assert model.transform(df).where("prediction != label_d").count() == 0


def test_odd_labels_are_refused(spark):
    for label in (None, -1.0, 0.5):
        df = spark.createDataFrame([([1.0, 2.0], 0.0), ([2.0, 1.0], label)], "x array<double>, label_d double")
        with pytest.raises(ValueError):
            _forest(numTrees=2).fit(df.withColumn("features", array_to_vector("x")))
