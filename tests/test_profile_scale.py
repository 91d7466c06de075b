import numpy as np
import pandas as pd
import pytest

from sparkfeat.operators import profile as P
from sparkfeat.operators.ranks import quantile_values
from sparkfeat.operators.scale import Scaler, ScalerModel


@pytest.fixture(scope="module")
def edge(spark):
    rng = np.random.default_rng(7)
    n = 501
    x = rng.normal(0, 1, n)
    x[:200] = 0.25  # heavy tie
    x[3] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "x": x, "y": rng.uniform(-5, 5, n), "c": 2.0, "k": rng.choice(list("abc"), n)})
    pdf.loc[4, "x"] = -0.0
    return spark.createDataFrame(pdf), pdf


def test_quantiles_match_numpy(spark, edge):
    df, pdf = edge
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    lin = quantile_values(df, ["x", "y", "c"], qs, "linear", accuracy=100)  # coarse sketch: brackets must still hold
    for c in ("x", "y", "c"):
        v = pdf[c].dropna().to_numpy()
        for q in qs:
            assert lin[(c, q)] == pytest.approx(np.quantile(v, q), abs=1e-12)
    near = quantile_values(df, ["y"], qs, "nearest")
    v = np.sort(pdf["y"].to_numpy())
    for q in qs:
        assert near[("y", q)] == v[int(round((len(v) - 1) * q))]


def test_quantile_single_row(spark):
    df = spark.createDataFrame([(1, 3.5)], "id long, x double")
    assert quantile_values(df, ["x"], [0.25, 0.5], "linear") == {("x", 0.25): 3.5, ("x", 0.5): 3.5}


def test_histogram_keeps_empty_bins(spark):
    pdf = pd.DataFrame({"x": [0.0, 0.1, 0.2, 9.9, 10.0]})
    h = P.histogram(spark.createDataFrame(pdf), ["x"], 10).orderBy("bin").toPandas()
    counts, _ = np.histogram(pdf["x"], bins=10)
    assert h["count"].tolist() == counts.tolist()


def test_dedup_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    r = P.dedup_report(df).first()
    assert (r["before"], r["after"], r["removed"]) == (3, 2, 1)


def test_describe_and_nulls(spark, edge):
    df, pdf = edge
    d = P.describe(df, ["x"]).first()
    assert d["count"] == pdf["x"].count() and d["nulls"] == 1
    assert d["std"] == pytest.approx(pdf["x"].std(), rel=1e-12)
    n = {r["column"]: r["null_count"] for r in P.null_counts(df).collect()}
    assert n["x"] == 1 and n["__total__"] == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double")
    assert P.shape(df).first()["n_rows"] == 0
    assert quantile_values(df, ["x"], [0.5])[("x", 0.5)] is None


@pytest.mark.parametrize("kind,ddof", [("minmax", 1), ("minmax_safe", 1), ("standard", 1), ("standard", 0),
                                       ("robust", 1), ("maxabs", 1)])
def test_scalers(spark, edge, kind, ddof, tmp_path):
    df, pdf = edge
    m = Scaler(kind, ["y", "c"], ddof).fit(df)
    out = m.transform(df).orderBy("id").toPandas()
    y = pdf["y"].to_numpy()
    exp = {"minmax": (y - y.min()) / (y.max() - y.min()), "minmax_safe": (y - y.min()) / (y.max() - y.min()),
           "standard": (y - y.mean()) / y.std(ddof=ddof),
           "robust": (y - np.median(y)) / (np.quantile(y, 0.75) - np.quantile(y, 0.25)),
           "maxabs": y / np.abs(y).max()}[kind]
    assert np.allclose(out["y"], exp)
    const = {"minmax": np.nan, "minmax_safe": 0.0, "standard": np.nan if ddof == 1 else 0.0, "robust": 0.0,
             "maxabs": 1.0}[kind]
    assert np.allclose(out["c"], const, equal_nan=True)
    back = m.inverse(m.transform(df)).orderBy("id").toPandas()
    assert np.allclose(back["y"], y)
    path = str(tmp_path / "scaler")
    m.save(spark, path)
    assert repr(ScalerModel.load(spark, path).params) == repr(m.params)  # NaN-safe
