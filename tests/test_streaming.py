from pyspark.sql import functions as F

from sparkfeat.operators.scale import Scaler
from sparkfeat.session import scratch_path
from sparkfeat.streaming import append_batch_metrics, score_stream


def test_stream_scoring_appends_metrics(spark):
    src = "/root/testdata/sf0.001/lineitem.parquet"
    static = spark.read.parquet(src)
    model = Scaler("minmax", ["l_quantity"]).fit(static)
    stream = (spark.readStream.schema(static.schema).option("pathGlobFilter", "lineitem.parquet")
              .parquet("/root/testdata/sf0.001"))
    scored = score_stream(stream, model.transform).select(
        F.col("l_returnflag").alias("label"), F.when(F.col("l_quantity") > 0.5, "A").otherwise("N").alias("pred"))
    out = scratch_path(spark, "stream-metrics")
    q = append_batch_metrics(scored, out, checkpoint=scratch_path(spark, "stream-ckpt"))
    q.awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert len(rows) >= 1 and 0.0 <= rows[0]["accuracy"] <= 1.0


def test_a_repeated_batch_leaves_one_record(spark):
    from sparkfeat.sources import files as S
    path = scratch_path(spark, "metrics-again")
    for run, value in (("batch-0", 0.5), ("batch-1", 0.7), ("batch-0", 0.5), ("batch-0", 0.6)):
        S.append_metrics(spark.createDataFrame([(value,)], "accuracy double"), path, run)
    assert {(r["run"], r["accuracy"]) for r in S.read_metrics(spark, path).collect()} == {("batch-0", 0.6), ("batch-1", 0.7)}
    assert S.read_metrics(spark, path).count() == 2
