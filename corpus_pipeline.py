"""Corpus pipeline: quality, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the
columns of ``docs``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.llm import decontam, jaccard, mixing, quality, sharding
from sparkfeat.llm.common import materialize, release, text_batches


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the documents that the importance resampling draws."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each group of near copies."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the documents that hold no benchmark item."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: a row for each copy that the mix takes, in training order."""
    return mixing.mixed(docs)


def shard_assignment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the shard and slot of every row."""
    return sharding.shard_documents(docs).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("shard_assignment", shard_assignment),
]

#: SQL cannot express the fitted model, the edit matching and the label propagation;
#: tests/llm/test_pipeline.py holds every stage against a brute-force version.
ORACLE_SQL = None


def _stage(stage):
    """What the stage before left on the driver goes first; Arrow batches of texts are small."""
    def step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark)
        text_batches(spark)
        return stage(spark, docs, sf_dir)
    step.__name__, step.__doc__ = stage.__name__, stage.__doc__
    return step


STAGES = [(name, _stage(stage)) for name, stage in STAGES]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
