"""Partitions of training tables: few for a small table, none that grows with a large one."""
import numpy as np

from sparkfeat.operators import models as M
from sparkfeat.plans import queries as Q


def _rows(spark, n, parts):
    return spark.range(0, n, 1, parts).selectExpr("id", "array(double(id % 7), double(id % 5)) x", "int(id % 2) y")


def test_a_full_partition_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(M, "ROWS_A_TASK", 50)
    monkeypatch.setattr(M, "VALUES_A_TASK", 200)
    df = _rows(spark, 1000, 1)
    assert M.fullest_partition(df) == (1000, 1000)
    out = M.spread(df, 1000, 1000, 2, 50)
    sizes = [r["count"] for r in out.groupBy(M.F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and len(sizes) == 10 and max(sizes) <= 200
    model, _ = M.fit_model("naive_bayes", df, "x", "y")
    assert M.n_params(model) == 2 * 2 * 2 + 2


def test_a_small_table_has_few_partitions(spark):
    df = _rows(spark, 1000, 8)
    n, most = M.fullest_partition(df)
    assert (n, most) == (1000, 125)
    assert M.spread(df, n, most, 2).rdd.getNumPartitions() == 1
    assert M.fullest_partition(df.where("id < 0")) == (0, 0)


def test_grid_frames_have_few_partitions(spark, tmp_path):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=4).tolist(), i % 3) for i in range(240)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    train, test = Q._cv_frames(spark, str(tmp_path), 3)
    assert train.rdd.getNumPartitions() == 1
    assert train.count() + test.count() == 240 and train.select("fold").distinct().count() == 3


def test_forest_keeps_node_ids():
    est = M.estimator("forest", 100, 4, 2)
    assert est.getCacheNodeIds() and est.getNumTrees() == 30 and est.getMaxDepth() == 20
