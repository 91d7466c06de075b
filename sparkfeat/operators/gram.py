"""Pairwise moments of many columns: a blocked Gram matrix in one scan.

Each task multiplies its batches as matrices: with X (nulls as 0) and M (1 where a value
is), M'M counts the rows that a pair of columns has in common, X'M sums one column over
them, X'X the products.  Batches are centred on their own means first, and batches, tasks
and blocks are merged by the parallel update of means and squared differences, so large
offsets cost no digits.  A task sends one row for each block of ``BLOCK`` columns, merged
in two steps by block; no operator holds a buffer a pair.
"""
from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame

from ..plans.order import plan_bytes

BLOCK = 64  # columns of a block
MERGE_BYTES = 8 << 30  # input of a first merge, about (64 tasks)

_SCHEMA = "block int, part int, moments binary"


def _merge(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    """Moments (n, mean of row column, mean of other column, co-moment, squares of each)."""
    if a is None:
        return b
    n = a[0] + b[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(n > 0, b[0] / n, 0.0)
        both = np.where(n > 0, a[0] * b[0] / n, 0.0)
    dx, dy = b[1] - a[1], b[2] - a[2]
    return np.stack([n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dy * both,
                     a[4] + b[4] + dx * dx * both, a[5] + b[5] + dy * dy * both])


def batch_moments(x: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Moments (6, columns, columns) of rows with missing values."""
    m = there.astype(np.float64)
    count = m.sum(0)
    centre = np.divide(np.where(there, x, 0.0).sum(0), count, out=np.zeros(x.shape[1]), where=count > 0)
    z = np.where(there, x - centre, 0.0)
    n, s, q = m.T @ m, z.T @ m, (z * z).T @ m  # s[i, j]: sum of column i over the rows that j has too
    safe = np.maximum(n, 1.0)
    mean = s / safe
    return np.stack([n, np.where(n > 0, mean + centre[:, None], 0.0), np.where(n > 0, mean.T + centre[None, :], 0.0),
                     z.T @ z - s * mean.T, q - s * mean, (q - s * mean).T])


def _rows(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 4_096):
                cut = batch.slice(lo, 4_096)
                x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in cut.columns])
                there = np.column_stack([~np.asarray(c.is_null()) for c in cut.columns])
                got = _merge(got, batch_moments(x, there))
        if got is None:
            return
        task = TaskContext.get().partitionId()
        at = range(0, got.shape[1], BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array([b // BLOCK for b in at], pa.int32()), pa.array([task % parts] * len(at), pa.int32()),
             pa.array([np.ascontiguousarray(got[:, b:b + BLOCK]).tobytes() for b in at], pa.binary())],
            ["block", "part", "moments"])
    return run


def _summed(d: int):
    def run(table: pa.Table) -> pa.Table:
        got, block = None, table["block"][0].as_py()
        for m in table["moments"]:
            got = _merge(got, np.frombuffer(m.as_buffer(), np.float64).reshape(6, -1, d))
        return pa.table({"block": pa.array([block], pa.int32()), "part": pa.array([0], pa.int32()),
                         "moments": pa.array([got.tobytes()], pa.binary())})
    return run


def _corr(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(names)
        for batch in batches:
            for block, m in zip(batch.column(0).to_pylist(), batch.column(2)):
                n, _, _, c, x, y = np.frombuffer(m.as_buffer(), np.float64).reshape(6, -1, d)
                with np.errstate(divide="ignore", invalid="ignore"):
                    r = c / np.sqrt(x * y)
                r[(n < 2) | (x <= 0) | (y <= 0)] = np.nan
                own = names[block * BLOCK:block * BLOCK + len(r)]
                for a, row in zip(own, r):
                    yield pa.RecordBatch.from_arrays([pa.array([a] * d), pa.array(names), pa.array(row, from_pandas=True)],
                                                     ["col_a", "col_b", "corr"])
    return run


def correlations(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(col_a, col_b, corr) of every pair of ``columns`` (name: double expression)."""
    names = list(columns)
    parts = max(1, min(1_024, (plan_bytes(df) or 0) // MERGE_BYTES))
    slim = df.select(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(columns.values())])
    rows = slim.mapInArrow(_rows(parts), _SCHEMA)
    if parts > 1:
        rows = rows.groupBy("block", "part").applyInArrow(_summed(len(names)), _SCHEMA)
    rows = rows.groupBy("block").applyInArrow(_summed(len(names)), _SCHEMA)
    found = rows.mapInArrow(_corr(names), "col_a string, col_b string, corr double")
    if df.limit(1).count():
        return found
    pairs = [(a, b) for a in names for b in names]
    return df.sparkSession.createDataFrame([(a, b, None) for a, b in pairs], "col_a string, col_b string, corr double")
