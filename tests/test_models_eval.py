import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkfeat.functions import spectral as SP
from sparkfeat.operators import compress as C
from sparkfeat.operators import evaluate as V
from sparkfeat.operators import knn as K
from sparkfeat.operators import split as L
from sparkfeat.operators.isoforest import IsolationForest
from sparkfeat.operators.naive_bayes import GaussianNB


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(150):
        lab = i % 3
        rows.append((i, [float(v) for v in rng.normal(lab * 5.0, 0.5, 4)], lab))
    return spark.createDataFrame(rows, "id long, features array<double>, label int")


def test_split_invariants(spark):
    emb = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    sp = L.stratified_split(emb, "label", "vec_id").toPandas()
    assert len(sp) == 500 and sp["vec_id"].is_unique
    assert (sp["split"] == "test").sum() == 100
    per = sp.groupby("label")["split"].apply(lambda s: (s == "test").sum())
    counts = sp.groupby("label").size()
    assert (abs(per - counts * 0.2) < 1).all()


def test_folds_balanced(spark):
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    f = L.stratified_folds(lab, "quality", "doc_id", 5).toPandas()
    sizes = f.groupby(["quality", "fold"]).size().unstack()
    assert (sizes.max(axis=1) - sizes.min(axis=1) <= 1).all()


def test_nb_and_knn_learn(spark, separable):
    sp = L.stratified_split(separable, "label", "id")
    tr, te = sp.where("split = 'train'"), sp.where("split = 'test'")
    nb = GaussianNB("features", "label", "id").fit(tr).predict(te)
    assert V.accuracy(nb).first()["accuracy"] == 1.0
    kn = K.knn_predict(tr, te, 5, "id", "label", "features")
    assert V.accuracy(kn).first()["accuracy"] == 1.0


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    ref = [(i, [float(v) for v in rng.normal(size=8)], int(rng.integers(0, 3))) for i in range(300)]
    qry = [(1000 + i, [float(v) for v in rng.normal(size=8)], 0) for i in range(40)]
    r = spark.createDataFrame(ref, "id long, features array<double>, label int").repartition(4)
    q = spark.createDataFrame(qry, "id long, features array<double>, label int")
    nb = K.neighbours(r, q, 5, ref_block=70, query_block=16).toPandas()  # 5 x 3 block grid
    R = np.array([x[1] for x in ref])
    for qid, feats, _ in qry:
        d = np.sqrt(((R - np.array(feats)) ** 2).sum(1))
        exp = np.lexsort((np.arange(300), d))[:5]
        got = nb[nb.qid == qid].sort_values("rank")["cid"].tolist()
        assert got == exp.tolist()


def test_metric_invariants(spark):
    pdf = pd.DataFrame({"label": [0, 0, 1, 1, 2, 2, 2], "pred": [0, 1, 1, 1, 0, 3, 2]})
    df = spark.createDataFrame(pdf)
    cm = V.confusion(df).toPandas()
    assert cm["count"].sum() == len(pdf) and len(cm) == 16
    w = V.weighted_prf(df).first()
    assert w["recall"] == pytest.approx(w["accuracy"])
    rep = {r["row"]: r for r in V.class_report(df).collect()}
    assert rep["3"]["precision"] == 0.0 and rep["3"]["support"] == 0
    assert rep["0"]["precision"] == pytest.approx(0.5)


def test_half_and_int8_match_numpy(spark):
    rng = np.random.default_rng(4)
    vals = np.concatenate([rng.normal(0, 10, 3000), rng.normal(0, 1e-6, 500), [0.0, 65519.0, 65520.0, -7e4, 1e-8]])
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    got = C.half(df, "x", "h").toPandas()["h"].to_numpy()
    assert np.array_equal(got, vals.astype(np.float16).astype(np.float64))
    vec = spark.createDataFrame([(1, [float(v) for v in vals[:64]])], "id long, v array<double>")
    q = C.quantize_vectors(vec, "v").first()
    s = np.abs(vals[:64]).max() / 127
    assert list(q["codes"]) == np.clip(np.round(vals[:64] / s), -127, 127).astype(np.int8).tolist()


def test_affine_error_bound(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    params = C.calibrate(li, ["l_extendedprice", "l_tax"])
    err = {r["column"]: r for r in C.quantization_error(li, params).collect()}
    assert all(r["within_bound"] for r in err.values())


def test_prune_exact_sparsity(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 1000), "w": rng.normal(size=1000), "k": np.arange(1000)})
    p = C.prune(spark.createDataFrame(pdf), "w", "g", 0.7, tie="k", out="wp").toPandas()
    for g, grp in p.groupby("g"):
        n = len(grp)
        assert (grp["wp"] == 0).sum() == n - round(n * 0.3)
        kept = grp[grp["wp"] != 0]
        assert kept["w"].abs().min() >= grp[grp["wp"] == 0]["w"].abs().max()


@pytest.mark.parametrize("n", [97, 360, 1001])
def test_global_fft_matches_numpy(spark, n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=n)
    pdf = pd.DataFrame({"t": np.arange(n), "x": x})
    spec = SP.spectrum_global(spark.createDataFrame(pdf), "x", ["t"], summary=False).toPandas().sort_values("k")
    assert np.allclose(spec["mag"].to_numpy(), np.abs(np.fft.fft(x)), atol=1e-9)


@pytest.mark.parametrize("n", [97, 1000])
def test_chirp_z_matches_numpy(spark, n):
    rng = np.random.default_rng(n + 1)
    x = rng.normal(size=n)
    pdf = pd.DataFrame({"t": np.arange(n), "x": x})
    rows = spark.createDataFrame(pdf).selectExpr("t AS idx", "x AS re")
    spec = SP._bluestein(rows, n).selectExpr("k", "sqrt(re * re + im * im) AS mag").toPandas()
    spec = spec.sort_values("k")
    assert len(spec) == n
    assert np.allclose(spec["mag"].to_numpy(), np.abs(np.fft.fft(x)), atol=1e-8)


def test_isolation_forest_finds_planted(spark):
    rng = np.random.default_rng(6)
    X = rng.normal(0, 1, (2000, 3))
    X[:40] += 12.0
    pdf = pd.DataFrame(X, columns=["a", "b", "c"]).assign(id=np.arange(2000))
    out = IsolationForest(["a", "b", "c"], trees=50, contamination=0.02).fit(spark.createDataFrame(pdf))
    flagged = out.transform(spark.createDataFrame(pdf)).where("is_outlier").select("id").toPandas()["id"]
    assert set(range(40)) <= set(flagged)
