"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the scratch folder is ``spark.checkpoint.dir`` (a shared, reliable
file system).  We never fall back to a machine-local temp folder there; only
``local_session`` (tests, bench) sets one when it is unset.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "sparkfeat") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.default.parallelism", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.  Where none is set, a local one is made for a
    session whose driver and executors are one process (tests, bench); on a cluster that
    is an error, since executors would not see each other's files."""
    d = checkpoint_dir(spark)
    if d:
        return d
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="sparkfeat-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def checkpoint_dir(spark: SparkSession) -> str | None:
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    try:
        d = spark.sparkContext._jsc.sc().getCheckpointDir()
        if d.isDefined():
            return d.get()
    except Exception:  # pragma: no cover - connect sessions have no JVM context
        pass
    return None


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    if not base:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; sparkfeat writes intermediate tables there"
        )
    return os.path.join(base, "sparkfeat", f"{tag}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as parquet to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor later re-reads the table instead of
    re-running (and possibly re-sampling) the upstream plan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
