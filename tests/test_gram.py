"""Correlation by blocked moments; duplicate counts by fingerprints; sizes of all types."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkfeat.operators import gram
from sparkfeat.operators import profile as P


def corr(df, cols):
    out = P.correlation(df, cols).toPandas()
    return out.pivot(index="col_a", columns="col_b", values="corr").loc[cols, cols].to_numpy()


def test_nulls_offsets_and_constants_as_pandas(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(2_000, 5))
    x[:, 1] += 0.5 * x[:, 0] + 1e9  # a large offset costs no digits
    x[:, 2] = 3.0
    pdf = pd.DataFrame(x, columns=list("abcde"))
    for c in "abd":
        pdf.loc[r.random(2_000) < 0.3, c] = None
    pdf.loc[1:, "e"] = None  # one value
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"{c} double" for c in "abcde")).repartition(7)
    want = pdf.corr().to_numpy()
    got = corr(df, list("abcde"))
    assert np.allclose(got, want, atol=1e-7, equal_nan=True)
    assert np.allclose(got[[0, 0, 3], [1, 3, 3]], want[[0, 0, 3], [1, 3, 3]], rtol=1e-6)


def test_five_hundred_columns_in_one_scan(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=(700, 500)) @ r.normal(size=(500, 500))
    df = spark.createDataFrame(pd.DataFrame({"v": list(map(list, x))})).repartition(4)
    df = df.select(*[F.col("v")[i].alias(f"c{i}") for i in range(500)])
    got = corr(df, df.columns)
    assert np.allclose(got, np.corrcoef(x.T), atol=1e-9)


def test_merging_any_way_gives_the_same():
    r = np.random.default_rng(7)
    x, there = r.normal(size=(300, 6)) + 1e6, r.random((300, 6)) < 0.7
    whole = gram.batch_moments(x, there)
    parts = None
    for lo in range(0, 300, 37):
        parts = gram._merge(parts, gram.batch_moments(x[lo:lo + 37], there[lo:lo + 37]))
    assert np.allclose(parts, whole, rtol=1e-9, atol=1e-6)


def test_empty_table_and_booleans(spark):
    df = spark.createDataFrame([], "a double, b boolean")
    assert P.correlation(df, ["a", "b"]).where("corr IS NULL").count() == 4
    df = spark.createDataFrame([(1.0, True), (2.0, False), (3.0, False), (4.0, None)], "a double, b boolean")
    assert corr(df, ["a", "b"])[0, 1] == pytest.approx(np.corrcoef([1, 2, 3], [1, 0, 0])[0, 1])


ROWS = [(1, "a", None), (1, "a", None), (1, None, None), (None, "a", None), (1, "", 0.0), (1, "", 0.0), (1, None, None),
        (2, "x" * 10_000, 1.0), (2, "x" * 10_000, 1.0), (2, "x" * 9_999 + "y", 1.0)]


@pytest.mark.parametrize("weak", [None, lambda cols: [F.lit(1), F.lit(2)], lambda cols: [F.length(cols[1]), F.lit(0)]])
def test_shared_fingerprints_are_compared_by_value(spark, weak):
    df = spark.createDataFrame(ROWS, "a long, b string, c double")
    got = P.dedup_report(df, weak).first() if weak else P.dedup_report(df).first()
    assert tuple(got) == (10, 6, 4)
    assert tuple(P.dedup_report(df.limit(0)).first()) == (0, 0, 0)


def test_texts_do_not_move(spark):
    """What is written for the exchange is a few numbers a row, however long the rows are."""
    df = spark.range(20_000).select(F.repeat(F.sha2(F.col("id").cast("string"), 256), 20).alias("text"), (F.col("id") % 7).alias("x"))
    h1, h2 = P._fingerprint([F.col("text"), F.col("x")])
    prints = df.select(h1.alias("h1"), h2.alias("h2")).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    plan = prints._jdf.queryExecution().executedPlan().toString()
    exchange = plan[plan.index("Exchange"):]
    assert "text" not in exchange.split("\n")[0] and "partial_count" in exchange
    assert tuple(P.dedup_report(df).first()) == (20_000, 20_000, 0)


def test_bytes_of_every_type(spark):
    df = spark.sql("SELECT 1.50BD AS d, CAST(1 AS DECIMAL(30, 2)) AS e, array(1, 2, 3) AS a, map(1, 2) AS m, 'é' AS s, CAST(NULL AS ARRAY<INT>) AS n")
    got = {r["column"]: r["bytes"] for r in P.column_bytes(df).collect()}
    assert got == {"d": 8, "e": 16, "a": 12, "m": None, "s": 2, "n": 0}
