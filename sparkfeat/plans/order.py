"""One order over a whole table without a single-task sort.

A pandas-style "sort by ts, then roll / shift / cumulate" needs each row's
position in the global order.  ``Window.orderBy`` without ``partitionBy``
moves every row into one task, so instead:

1. **Global index** (``global_index``): range-partition on the order key
   (plus tie-break), sort within partitions, and record the partition id and
   the in-partition position.  The table is written once to the shared
   checkpoint folder, which fixes the range bounds (Spark samples them per
   job) and cuts the lineage.  Offsets are a prefix sum over a table with one
   row per (partition, key) and are joined back; the row number is
   ``offset + position``.  A hot ``ts`` value (or a hot key) is split across
   range partitions because the bounds are on the full (key, order, tie) tuple.
2. **Chunks with halo** (``with_halo``): chunk = rn div C; the last ``halo``
   rows of each chunk are also sent to the next chunk, so a row frame of up to
   ``halo + 1`` rows is complete inside one chunk.  Chunks have a bounded size.
3. **Chunk scan** (``decay_scan`` and the EMA operator): a linear recurrence
   y_t = q * y_(t-1) + x_t runs per chunk on executors; the carry into each
   chunk comes from a one-row-per-chunk summary table.
"""
from __future__ import annotations

import math
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

MAX_CHUNK = 1 << 21  # rows per chunk at most (bounded memory per task)
TARGET_BUCKET_BYTES = 128 << 20  # bytes per range partition of the global index
MAX_BUCKETS = 200_000


def plan_bytes(df: DataFrame) -> int | None:
    """Bytes the plan reads: the sum of Catalyst's size estimates of its leaf
    relations (file scans, cached or local relations).  Unlike the estimate of
    the root, this does not inflate through joins."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        total = 0
        for i in range(leaves.size()):
            v = leaves.apply(i).stats().sizeInBytes()
            v = int(v if isinstance(v, int) else v.toString())
            if v < (1 << 62):  # Long.MaxValue means "unknown" (e.g. a driver-side table)
                total += v
        return total
    except Exception:  # noqa: BLE001 - e.g. Spark Connect sessions
        return None


def index_buckets(df: DataFrame) -> int:
    """Range partitions for the index: at least the shuffle partitions, and
    enough that each holds about TARGET_BUCKET_BYTES of the (projected) input."""
    base = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    size = plan_bytes(df)
    if size is None:
        return base
    return int(min(MAX_BUCKETS, max(base, -(-size // TARGET_BUCKET_BYTES))))


def _names(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` in which a null key meets a null key."""
    keys = list(keys)
    renamed = right.withColumnsRenamed({k: f"_right_{i}" for i, k in enumerate(keys)})
    on = [F.col(k).eqNullSafe(F.col(f"_right_{i}")) for i, k in enumerate(keys)]
    return left.join(renamed, on).drop(*[f"_right_{i}" for i in range(len(keys))])


def global_index(df: DataFrame, order: Sequence[str] | str, partition_by=None,
                 rn: str = "rn", buckets: int | None = None):
    """Add a 0-based row number ``rn`` in ``order`` (within ``partition_by`` keys).

    ``order`` must be a total order (append a unique tie-break column).  Null
    keys are a key of their own.
    Returns ``(indexed_df, sizes_df)`` where ``sizes_df`` has one row per key
    (one row in total without keys) with the column ``n``.
    """
    spark = df.sparkSession
    order, keys = _names(order), _names(partition_by)
    sort_cols = keys + order
    if buckets is None:
        buckets = index_buckets(df)
    ranged = (df.repartitionByRange(buckets, *sort_cols)
                .sortWithinPartitions(*sort_cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id()))
    ranged = materialize(ranged, "global-index")
    gcols = ["_pid"] + keys
    counts = ranged.groupBy(*gcols).agg(F.count(F.lit(1)).alias("_cnt"),
                                        F.min("_pos").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    offsets_small = offsets.select(*gcols, "_off", "_first")
    if not keys:
        # one row per range partition: bounded by ``buckets``
        offsets_small = F.broadcast(offsets_small)
    out = (null_safe_join(ranged, offsets_small, gcols)
                 .withColumn(rn, (F.col("_off") + F.col("_pos") - F.col("_first")).cast("long"))
                 .drop("_pid", "_pos", "_off", "_first"))
    sizes = counts.groupBy(*keys).agg(F.sum("_cnt").cast("long").alias("n"))
    return out, sizes


def total_rows(sizes: DataFrame) -> int:
    """Largest per-key size (the whole size without keys); bounded metadata."""
    r = sizes.agg(F.max("n")).first()[0]
    return int(r or 0)


def choose_chunk(n: int, halo: int, parallelism: int) -> int:
    """Rows per chunk: enough chunks for the cluster, never above MAX_CHUNK."""
    target = math.ceil(max(n, 1) / max(2 * parallelism, 1))
    return int(max(halo + 1, min(MAX_CHUNK, target), 1))


def with_halo(indexed: DataFrame, rn: str, chunk: int, halo: int) -> DataFrame:
    """Assign ``_chunk`` and duplicate the last ``halo`` rows of each chunk into
    the next one; ``_home`` marks the original copy."""
    if halo >= chunk:
        raise ValueError("chunk size must exceed the halo")
    c = F.floor(F.col(rn) / F.lit(chunk)).cast("long")
    tail = (F.col(rn) % F.lit(chunk)) >= F.lit(chunk - halo)
    shifts = F.when(tail, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))) if halo > 0 \
        else F.array(F.lit(0))
    return (indexed.withColumn("_shift", F.explode(shifts))
                   .withColumn("_chunk", c + F.col("_shift"))
                   .withColumn("_home", F.col("_shift") == 0)
                   .drop("_shift"))


def decay_scan(x: np.ndarray, q: float, block: int = 64) -> np.ndarray:
    """y_t = q * y_(t-1) + x_t with y_(-1) = 0, blocked so every weight is <= 1.

    Within a block: one matrix product with T[t, j] = q^(t-j) (j <= t).
    Across blocks: the block end values form the same recurrence with q^block,
    solved recursively, and are added back with weights q^(i+1).
    """
    x = np.asarray(x, dtype=np.float64)
    n = x.shape[0]
    if n == 0:
        return x.copy()
    L = block
    nb = -(-n // L)
    xp = np.zeros(nb * L)
    xp[:n] = x
    X = xp.reshape(nb, L)
    i = np.arange(L)
    d = i[:, None] - i[None, :]
    T = np.where(d >= 0, np.power(q, np.maximum(d, 0)), 0.0)
    local = X @ T.T
    if nb > 1:
        carry = decay_scan(local[:, -1], q ** L, block)
        prev = np.concatenate([[0.0], carry[:-1]])
        local = local + prev[:, None] * np.power(q, i + 1)[None, :]
    return local.reshape(-1)[:n]
