"""File sources and sinks.

* CSV scan / sink with header (S1-S3); schema declared, inference opt-in.
* Split feature store: one parquet table partitioned by ``split`` (S4); a
  reader of one split gets partition pruning instead of a second file.
* Append-only metric records (S5), model save/load (S7) and the stored size
  of a saved model folder (S8), read with the ``binaryFile`` source so the
  size is summed by executors.
* S9 (frame conversion) needs no code: data stays in the DataFrame.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_TS_FMT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             infer: bool = False) -> DataFrame:
    """CSV scan with a header row.  Pass ``schema``; ``infer=True`` samples the file."""
    reader = (spark.read.option("header", True)
              .option("timestampFormat", _TS_FMT)
              .option("timestampNTZFormat", _TS_FMT))
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV sink with a header and no index column; timestamps keep microseconds."""
    (df.write.mode(mode).option("header", True)
       .option("timestampFormat", _TS_FMT)
       .option("timestampNTZFormat", _TS_FMT)
       .csv(path))
    return path


def write_split(df: DataFrame, path: str, split_col: str = "split", mode: str = "overwrite") -> str:
    """Store a (id, features, label, split) table partitioned by split."""
    df.write.mode(mode).partitionBy(split_col).parquet(path)
    return path


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    """Read one split; the filter on the partition column prunes the other folders."""
    return spark.read.parquet(path).where(F.col(split_col) == F.lit(split))


def append_metrics(df: DataFrame, path: str, run: str) -> str:
    """Add the metric records of a run to a parquet table.

    A run is a partition that a write replaces as a whole, so a run that is repeated (a
    retried job, a micro-batch that is delivered again) leaves its records once."""
    (df.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run").parquet(path))
    return path


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, path: str) -> str:
    """Persist a pyspark.ml model / pipeline model or a sparkfeat fitted transform."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str, cls=None):
    """Load a saved model; ``cls`` defaults to PipelineModel."""
    if cls is None:
        from pyspark.ml import PipelineModel as cls  # noqa: N813
    return cls.load(path)


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Bytes, KB and MB stored under ``path`` (all files, recursively)."""
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", True)
             .load(path)
             .select("length"))
    return files.agg(
        F.count("*").alias("n_files"),
        F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("bytes"),
    ).select(
        "n_files", "bytes",
        (F.col("bytes") / 1024.0).alias("kb"),
        (F.col("bytes") / (1024.0 * 1024.0)).alias("mb"),
    )
