"""A metric index for exact nearest-neighbour search: pivots, cells, triangle bounds.

Every reference row belongs to the cell of its nearest pivot.  The pivots are at most
``MAX_CELLS`` rows picked by a hash of the key; the cell table (rows, radius) has one row
a pivot.  For a query q, a cell c with pivot p and radius r, and the query's own nearest
pivot p0, every row x of the cell has

    d(q, x) >= d(q, p) - r                  (ball)
    d(q, x) >= (d(q, p) - d(q, p0)) / 2     (x is no nearer to p0 than to p)

so a cell whose bound lies beyond the k-th distance found so far can't hold a neighbour.
Pivot distances are widened by their rounding error, so no tie is lost.
"""
from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

MAX_CELLS = 4_096
CELL_ROWS = 2_048  # rows of a cell where MAX_CELLS allows it
LEAST_ROWS = 64  # smaller tables have cells of so many rows, 16 at most


def cell_count(n: int) -> int:
    return int(min(MAX_CELLS, max(1, n // CELL_ROWS, min(16, n // LEAST_ROWS))))


def pivot_distances(Q: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends of the distances (queries x pivots)."""
    centre = pivots.mean(0)
    q, p = Q - centre, pivots - centre
    q2, p2 = (q * q).sum(1)[:, None], (p * p).sum(1)[None, :]
    d2 = q2 + p2 - 2.0 * (q @ p.T)
    err = 16.0 * (Q.shape[1] + 2) * np.finfo(np.float64).eps * (q2 + p2)
    return np.sqrt(np.maximum(d2 - err, 0.0)), np.sqrt(np.maximum(d2 + err, 0.0))


@dataclass
class Cells:
    """What a task needs to know of the cells; a few numbers a pivot."""
    pivots: np.ndarray
    sizes: np.ndarray  # rows by cell
    radii: np.ndarray
    slop: float  # how far a row's nearest pivot may be from the nearest as computed
    blocks: np.ndarray  # bounded parts by cell

    def bounds(self, Q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower bound of the distance to any row of the cell, pivot order) by query."""
        low, high = pivot_distances(Q, self.pivots)
        plane = (low - high.min(1)[:, None] - self.slop) / 2.0
        return np.maximum(np.maximum(low - self.radii[None, :], plane), 0.0), np.argsort(high, axis=1, kind="stable")


def build_index(rows: DataFrame, n: int, block: int, cells: int | None = None) -> tuple[DataFrame, Cells]:
    """``rows`` (cid, clabel, f, ...) with cell and sub, and the cells; parts of a cell hold
    about ``block`` rows."""
    cells = min(cells or cell_count(n), MAX_CELLS)
    picked = rows.select("cid", "f").orderBy(F.xxhash64("cid"), "cid").limit(cells).collect()  # bounded
    pivots = np.unique(np.array([np.asarray(r["f"], np.float64) for r in picked]), axis=0)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame) == 0:
                continue
            own, reach, slop = [], [], []
            X = np.stack(frame["f"].to_numpy()).astype(np.float64)
            for lo in range(0, len(X), 1_024):
                low, high = pivot_distances(X[lo:lo + 1_024], pivots)
                at = high.argmin(1)
                i = np.arange(len(at))
                own.append(at)
                reach.append(high[i, at])
                slop.append(high[i, at] - low.min(1))
            yield frame.assign(cell=np.concatenate(own).astype(np.int32), reach=np.concatenate(reach), slop=np.concatenate(slop))

    schema = T.StructType([*rows.schema, T.StructField("cell", T.IntegerType()), T.StructField("reach", T.DoubleType()),
                           T.StructField("slop", T.DoubleType())])
    placed = materialize(rows.mapInPandas(assign, schema), "metric-cells")
    stat = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("reach").alias("r"), F.max("slop").alias("s")).collect()
    sizes, radii = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
    for r in stat:  # a row a pivot
        sizes[r["cell"]], radii[r["cell"]] = r["n"], r["r"]
    blocks = np.maximum(1, -(-sizes // block))
    of = F.element_at(F.array(*(F.lit(int(b)) for b in blocks)), F.col("cell") + 1) if blocks.max(initial=1) > 1 else F.lit(1)
    placed = placed.withColumn("sub", F.pmod(F.xxhash64("cid"), of).cast("int")).drop("reach", "slop")
    return placed, Cells(pivots, sizes, radii, max((r["s"] for r in stat), default=0.0), blocks)


def cells_to_visit(index: Cells, wave: int, need: int, step: int):
    """mapInPandas over (qid, f, ..., tau): a row for each cell that the query visits now.

    Wave 0: the nearest cells that hold ``need`` rows; wave 1: of the others within
    ``tau`` the ``step`` with the least bounds; wave 2: the rest within ``tau``."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame) == 0:
                continue
            for lo in range(0, len(frame), 512):
                part = frame.iloc[lo:lo + 512]
                bound, order = index.bounds(np.stack(part["f"].to_numpy()).astype(np.float64))
                held = np.cumsum(index.sizes[order], axis=1)
                first = np.zeros(bound.shape, bool)
                np.put_along_axis(first, order, held - index.sizes[order] < need, axis=1)
                first &= index.sizes > 0
                if wave == 0:
                    visit = first
                else:
                    # tau of the first wave decides what the second took, whatever it is now
                    open_ = ~first & (index.sizes > 0)
                    seen = open_ & (bound <= part["tau0"].to_numpy()[:, None] * (1 + 1e-9))
                    ranked = np.where(seen, bound, np.inf)
                    rank = np.argsort(np.argsort(ranked, axis=1, kind="stable"), axis=1, kind="stable")
                    second = seen & (rank < step)
                    visit = second if wave == 1 else seen & ~second & (bound <= part["tau"].to_numpy()[:, None] * (1 + 1e-9))
                q, c = np.nonzero(visit)
                yield part.iloc[q].drop(columns=[x for x in ("tau", "tau0") if x in part]).assign(cell=c.astype(np.int32))
    return run
