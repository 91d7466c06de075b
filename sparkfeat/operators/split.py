"""Deterministic splits, subsets and folds.

Rows are ordered inside each class by a seeded hash of the key,
h = first 13 hex digits of md5("key|seed") as a 52-bit integer, then the key.
Splits, subsets and hold-outs need one cut value a class, found without sorting or
shuffling a row (``group_select``).  Folds need every row's rank: it comes from the
range-partitioned global index (``plans.order``), so a class holding a third of the
table is still spread over many tasks.  Allotments per class are largest-remainder
counts (bounded by the number of classes).
"""
from __future__ import annotations

import math
from typing import Dict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.order import global_index
from .group_select import first_rows, group_sizes


def hash_order(key: str, seed: int = 42):
    """52-bit seeded hash of a key: conv(substr(md5(key|seed), 1, 13), 16, 10)."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("long")


def largest_remainder(counts: Dict, total: int) -> Dict:
    """Split ``total`` over classes proportionally to ``counts``; extra units go to
    the largest remainders, ties to the smaller class value (a null class last)."""
    n = sum(counts.values())
    if n == 0:
        return {k: 0 for k in counts}
    exact = {k: total * c / n for k, c in counts.items()}
    base = {k: int(math.floor(v)) for k, v in exact.items()}
    left = total - sum(base.values())
    order = sorted(counts, key=lambda k: (-(exact[k] - base[k]), k is None, 0 if k is None else k))
    for k in order[:left]:
        base[k] += 1
    return base


def _first_by_class(df: DataFrame, label: str, key: str, seed: int, total, out: str) -> DataFrame:
    """Flags ``total`` of the rows (a function of their number), allotted to the classes by
    largest remainder, first by hash."""
    sizes = group_sizes(df, [label])
    counts = {r[label]: int(r["n"]) for r in sizes.collect()}  # one row per class
    alloc = largest_remainder(counts, total(sum(counts.values())))
    dtype = df.schema[label].dataType.simpleString()
    wanted = df.sparkSession.createDataFrame([(k, n, int(alloc[k])) for k, n in counts.items()],
                                             f"`{label}` {dtype}, n long, take long")
    return first_rows(df, [label], [hash_order(key, seed), F.col(key)], wanted, out)


def _class_ranks(df: DataFrame, label: str, key: str, seed: int):
    d = df.withColumn("_h", hash_order(key, seed))
    ranked, sizes = global_index(d, ["_h", key], [label], rn="_crn")
    return ranked, sizes


def stratified_split(df: DataFrame, label: str, key: str, test: float = 0.2, seed: int = 42,
                     out: str = "split") -> DataFrame:
    """``split`` = 'test' for ceil(test * n) rows allotted per class, else 'train' (L1)."""
    marked = _first_by_class(df, label, key, seed, lambda n: int(math.ceil(test * n)), "_in")
    return marked.withColumn(out, F.when(F.col("_in"), F.lit("test")).otherwise(F.lit("train"))).drop("_in")


def stratified_subset(df: DataFrame, label: str, key: str, n_rows: int, seed: int = 42) -> DataFrame:
    """Exactly ``n_rows`` rows (all rows if fewer), class shares kept (L2)."""
    marked = _first_by_class(df, label, key, seed, lambda n: min(n_rows, n), "_in")
    return marked.where("_in").drop("_in")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """``fold`` = class rank mod k: fold sizes per class differ by at most one (L4)."""
    ranked, _ = _class_ranks(df, label, key, seed)
    return ranked.withColumn(out, (F.col("_crn") % k).cast("int")).drop("_crn", "_h")


def tail_holdout(df: DataFrame, order, share: float = 0.2, out: str = "split") -> DataFrame:
    """The last ``share`` of rows in ``order`` are 'val' (rn >= floor(n (1 - share))) (L3)."""
    cut = F.floor(F.col("n") * F.lit(1.0 - share)).cast("long")
    wanted = group_sizes(df, []).withColumn("take", cut)
    order = [order] if isinstance(order, str) else list(order)
    marked = first_rows(df, [], [F.col(c) for c in order], wanted, "_in")
    return marked.withColumn(out, F.when(F.col("_in"), F.lit("train")).otherwise(F.lit("val"))).drop("_in")
