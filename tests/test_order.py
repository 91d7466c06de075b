import numpy as np
import pandas as pd
import pytest

from sparkfeat.operators import rolling as R
from sparkfeat.plans.order import decay_scan, global_index


def _series(spark, n=997, heavy=True, seed=3):
    rng = np.random.default_rng(seed)
    ts = rng.integers(0, 300, n)
    if heavy:  # one timestamp holds a third of the rows
        ts[: n // 3] = 77
    x = rng.normal(10, 3, n)
    x[5] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "ts": ts, "x": x})
    return spark.createDataFrame(pdf).repartition(5), pdf.sort_values(["ts", "id"]).reset_index(drop=True)


def test_global_index_matches_sort(spark):
    df, ref = _series(spark)
    out, sizes = global_index(df, ["ts", "id"], rn="rn", buckets=7)
    got = out.orderBy("rn").toPandas()
    assert list(got["rn"]) == list(range(len(ref)))
    assert list(got["id"]) == list(ref["id"])
    assert sizes.first()["n"] == len(ref)


def test_global_index_per_key(spark):
    df, ref = _series(spark, heavy=False)
    df = df.withColumn("k", (df.id % 3))
    out, sizes = global_index(df, ["ts", "id"], "k", rn="rn", buckets=4)
    got = out.toPandas()
    for k, g in got.groupby("k"):
        exp = g.sort_values(["ts", "id"])["id"].tolist()
        assert g.sort_values("rn")["id"].tolist() == exp
        assert sorted(g["rn"]) == list(range(len(g)))


def test_decay_scan_matches_recurrence():
    rng = np.random.default_rng(0)
    x = rng.normal(size=1000)
    for q in (0.0, 0.5, 0.9, 0.999):
        y, acc = np.empty_like(x), 0.0
        for i, v in enumerate(x):
            acc = q * acc + v
            y[i] = acc
        assert np.allclose(decay_scan(x, q), y, rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("chunk", [None, 50])
def test_rolling_matches_pandas(spark, chunk):
    df, ref = _series(spark)
    out = R.rolling(df, ["x"], ["ts", "id"], [3, 10], ("mean", "var"), chunk=chunk).toPandas()
    out = out.set_index("id").loc[ref["id"]].reset_index()
    for w in (3, 10):
        pm = ref["x"].rolling(w).mean().to_numpy()
        pv = ref["x"].rolling(w).var().to_numpy()
        assert np.allclose(out[f"x_MA_{w}"].to_numpy(dtype=float), pm, equal_nan=True, atol=1e-9)
        assert np.allclose(out[f"x_VAR_{w}"].to_numpy(dtype=float), pv, equal_nan=True, atol=1e-8)


def test_rolling_min_periods(spark):
    df, ref = _series(spark)
    out = R.rolling(df, ["x"], ["ts", "id"], [3], ("mean",), min_periods=1, chunk=40).toPandas()
    out = out.set_index("id").loc[ref["id"]]
    assert np.allclose(out["x_MA_3"].to_numpy(dtype=float), ref["x"].rolling(3, min_periods=1).mean(), equal_nan=True)


@pytest.mark.parametrize("chunk", [None, 64])
def test_ema_matches_pandas_with_nulls(spark, chunk):
    df, ref = _series(spark)
    out = R.ema(df, ["x"], ["ts", "id"], [3, 20, 100], chunk=chunk).toPandas().set_index("id").loc[ref["id"]]
    for w in (3, 20, 100):
        exp = ref["x"].ewm(span=w).mean().to_numpy()
        assert np.allclose(out[f"x_EMA_{w}"].to_numpy(dtype=float), exp, atol=1e-10, equal_nan=True)


def test_ema_null_repeats_last(spark):
    pdf = pd.DataFrame({"id": [0, 1, 2], "ts": [0, 1, 2], "x": [1.0, np.nan, 2.0]})
    out = R.ema(spark.createDataFrame(pdf), ["x"], ["ts", "id"], [3]).orderBy("id").toPandas()
    assert np.allclose(out["x_EMA_3"], [1.0, 1.0, 1.8])


def test_sign_changes(spark):
    df, ref = _series(spark, heavy=False)
    df = df.fillna(0.0)
    ref = ref.fillna(0.0)
    out = R.sign_changes(df, ["x"], ["ts", "id"], chunk=30).toPandas().set_index("id").loc[ref["id"]]
    x = ref["x"].to_numpy()
    exp = np.concatenate([[False], np.diff(np.sign(x - x.mean())) != 0])
    assert (out["x_sign_change"].to_numpy() == exp).all()


def test_partitioned_rolling(spark):
    df, ref = _series(spark, heavy=False)
    df = df.withColumn("k", df.id % 4)
    out = R.rolling(df, ["x"], ["ts", "id"], [4], ("mean",), partition_by="k", chunk=20).toPandas()
    ref = ref.assign(k=ref.id % 4)
    for k, g in ref.groupby("k"):
        exp = g["x"].rolling(4).mean().to_numpy()
        got = out.set_index("id").loc[g["id"], "x_MA_4"].to_numpy(dtype=float)
        assert np.allclose(got, exp, equal_nan=True)


def test_single_bins_agree_with_the_transform(spark):
    import numpy as np

    from sparkfeat.functions import spectral as SP
    for n in (1, 2, 97, 600):
        x = np.random.default_rng(n).normal(size=n)
        df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i long, v double").repartition(3)
        want = np.fft.fft(x)
        got = SP.spectrum_at(df, "v", ["i"], [0, 1, n // 2, n - 1, n + 5]).collect()
        assert {r["k"] for r in got} == {k for k in (0, 1, n // 2, n - 1) if k < n}
        for r in got:
            assert np.isclose(complex(r["re"], r["im"]), want[r["k"]], atol=1e-9)
    assert SP.spectrum_at(df.limit(0), "v", ["i"], [0]).count() == 0
