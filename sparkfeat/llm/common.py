"""Small helpers of this subpackage: tables, row keys, sizes and scratch."""
from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.order import plan_bytes
from ..session import materialize

__all__ = ["materialize", "parts_for", "fresh", "row_key", "wide_key", "shared_keys", "renamed", "running_sum", "release", "text_batches", "trimmed", "bitmap", "maybe"]

BITMAP_WORDS = 1 << 17  # rows of a bitmap table at most: 1 MB of bits, safe to broadcast


def parts_for(df: DataFrame, part_bytes: int = 32 << 20) -> int:
    """Partitions for a shuffle of about the bytes the plan scans: the session's
    shuffle partitions at least, more as the input grows."""
    base = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(base, -(-(plan_bytes(df) or 0) // part_bytes))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet (inputs may hold clashing names)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def row_key(*columns: Column) -> Column:
    """A 64-bit key of a row's values, nulls told from empty strings."""
    return F.xxhash64(*(x for c in columns for x in (c.isNull(), c)))


def wide_key(*columns: Column) -> Column:
    """A 128-bit key of a row's values: two hashes of different seeds."""
    return F.struct(*(row_key(F.lit(seed), *columns).alias(f"h{seed}") for seed in (1, 2)))


def shared_keys(classes: DataFrame, key: str, low: str, high: str) -> list[int]:
    """64-bit keys that different values share: those whose least and greatest second key
    differ.  Of n values about n * n / 2**65 share one, some hundreds of 1e11."""
    return [r[0] for r in classes.where(F.col(low) != F.col(high)).select(key).collect()]


def renamed(rows: DataFrame, key: str, second: str, shared: list[int]) -> DataFrame:
    """``rows`` whose shared keys give way to their second keys."""
    return rows.withColumn(key, F.when(F.col(key).isin(shared), F.col(second)).otherwise(F.col(key)))


def running_sum(rows: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """``rows`` (written once) with the sum of ``value`` over the rows of the same keys before
    each, in an order that should be total.  Range partitions are summed first, so neither a
    hot key nor a hot place in the order meets in one task."""
    at, part, base, inner, total = (fresh(rows, c) for c in ("_at", "_part", "_base", "_inner", "_total"))
    by = keys + order
    parts = max(parts_for(rows), 1)
    ranged = materialize(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
                         .withColumn(at, F.monotonically_increasing_id())
                         .withColumn(part, F.spark_partition_id()), "running-sum")
    sums = ranged.groupBy(*keys, part).agg(F.sum(value).alias(total))
    ahead = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, part, F.coalesce(F.sum(total).over(ahead), F.lit(0)).alias(base))
    inside = Window.partitionBy(*keys, part).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    ranged = ranged.withColumn(inner, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = ranged.join(sums, [*keys, part])
    return joined.withColumn(out, (F.col(base) + F.col(inner)).cast("long")).drop(at, part, base, inner)


def release(spark: SparkSession) -> None:
    """Lets go of finished plans, and with them of the driver's broadcasts and shuffle
    records, before the next long step."""
    gc.collect()
    spark._jvm.System.gc()


def text_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Arrow batches of at most ``rows`` rows from now on: whole texts are wide rows, and the
    JVM and Python each hold a batch or two a task."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def trimmed(run: Callable) -> Callable:
    """A partition function after which the Python worker, which Spark keeps for later tasks,
    gives its freed memory back to the system."""
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
            if trim:
                trim(0)
    return whole


def _word(key: Column) -> Column:
    return F.shiftrightunsigned(key, 64 - 17)


def _bit(key: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63)).cast("int"))


def bitmap(keys: DataFrame, key: str) -> DataFrame:
    """Which of 2**23 hash values occur among ``keys``: ``BITMAP_WORDS`` rows at most,
    however many keys there are.  More keys only make ``maybe`` less sharp."""
    return (keys.where(F.col(key).isNotNull()).groupBy(_word(F.col(key)).alias("w"))
            .agg(F.bit_or(_bit(F.col(key))).alias("bits")))


def maybe(df: DataFrame, bits: DataFrame, key: Column, out: str) -> DataFrame:
    """``df`` with a flag: false means that the key is not in the bitmap's table for sure."""
    w, b = fresh(df, "_w"), fresh(df, "_bits")
    bits = F.broadcast(bits.select(F.col("w").alias(w), F.col("bits").alias(b)))
    return (df.withColumn(w, _word(key)).join(bits, w, "left")
            .withColumn(out, F.coalesce(F.col(b).bitwiseAND(_bit(key)) != 0, F.lit(False))).drop(w, b))
