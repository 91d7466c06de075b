"""A key or timestamp holding a third of all rows must not land in one task."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sparkfeat.operators import split as L
from sparkfeat.plans.order import global_index


def _skewed(spark, n=3000):
    rng = np.random.default_rng(11)
    key = rng.integers(0, 50, n)
    key[: n // 3] = 7  # hot key: a third of the rows
    ts = rng.integers(0, 10_000, n)
    ts[: n // 6] = 42  # hot timestamp inside the hot key
    return pd.DataFrame({"id": np.arange(n), "k": key, "ts": ts})


def test_hot_key_spans_many_range_partitions(spark):
    pdf = _skewed(spark)
    df = spark.createDataFrame(pdf)
    ranged = (df.repartitionByRange(16, "k", "ts", "id").sortWithinPartitions("k", "ts", "id")
                .withColumn("_pid", F.spark_partition_id()))
    parts = ranged.where(F.col("k") == 7).select("_pid").distinct().count()
    assert parts >= 4  # the hot key is split by (ts, id)
    out, sizes = global_index(df, ["ts", "id"], "k", rn="rn", buckets=16)
    hot = out.where(F.col("k") == 7).orderBy("rn").toPandas()
    exp = pdf[pdf.k == 7].sort_values(["ts", "id"])["id"].tolist()
    assert hot["id"].tolist() == exp and hot["rn"].tolist() == list(range(len(exp)))


def test_split_exact_under_class_skew(spark):
    pdf = _skewed(spark)
    df = spark.createDataFrame(pdf)
    sp = L.stratified_split(df, "k", "id", 0.2).toPandas()
    n_test = int(np.ceil(0.2 * len(pdf)))
    assert (sp["split"] == "test").sum() == n_test
    hot = sp[sp.k == 7]
    assert abs((hot["split"] == "test").sum() - 0.2 * len(hot)) < 1
