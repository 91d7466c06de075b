"""Isolation forest (O3): contamination-based outlier flags.

fit: every tree draws ``sample`` rows of its own without replacement, however
few rows there are.  Equal rows are counted first (one exchange of the feature columns,
combined before it, so a value of a third of the table is a row a task); then each copy
has a draw of its own in every tree: the least of c draws come one after the other as
order statistics of hashes of (seed, row, tree, copy), as far as a bound that slightly more
than ``sample`` rows of the table pass.  A task keeps the ``sample`` least draws of a tree
(``bottom``), and the merged lists give the tree's rows, so no group holds more than
about ``sample`` rows beyond the bound.  The draw depends on the rows' values (or
``key``), not on files or partitions.  Trees grow on executors with
``groupBy(tree).applyInPandas``.  The forest - at most
trees x (2 sample - 1) nodes - is the model; it is collected once and broadcast.
score: a vectorised descent of all trees per Arrow batch in
``mapInPandas``; s = 2^(-E[h(x)] / c(sample)).  Flags: score above the exact
(1 - contamination) quantile of all scores.  Tree draws differ from sklearn's.
"""
from __future__ import annotations

import math
from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .ranks import quantile_values

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size long"


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) to uniform draws in [0, 1)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def first_bound(copies: np.ndarray, bound: float) -> np.ndarray:
    """What the uniform of a row's least draw stays below where that draw is below ``bound``,
    with some room for rounding."""
    if bound >= 1.0:
        return np.ones(len(copies))
    return -np.expm1(copies * np.log1p(-bound)) * (1.0 + 1e-9) + 1e-15


def draws(row: np.ndarray, copies: np.ndarray, tree: int, seed: int, bound: float,
          first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(index of the row, draw) of all copies with a draw below ``bound`` in a tree; ``first``
    is ``first_bound``, where many trees share it."""
    base = row.view(np.uint64) ^ np.uint64((seed * 0x632BE59BD9B4E019 + tree * 0xD6E8FEB86659FD93) % (1 << 64))
    # all but a few rows have no draw below the bound: their first one is seen before its logarithm is taken
    at = np.flatnonzero(_mix(base) <= first_bound(copies, bound) if first is None else _mix(base) <= first)
    low, j = np.zeros(len(at)), 0
    index, value = [], []
    while len(at):  # the j-th least draw of each row that still has one below the bound
        u = _mix(base[at] + np.uint64((j * 0xA0761D6478BD642F) % (1 << 64)))
        low = low + (1.0 - low) * -np.expm1(np.log1p(-u) / (copies[at] - j))
        keep = low < bound
        index.append(at[keep])
        value.append(low[keep])
        j += 1
        go = keep & (copies[at] > j)
        at, low = at[go], low[go]
    return np.concatenate(index) if index else at, np.concatenate(value) if value else low


def _grow(X: np.ndarray, rng: np.random.Generator, limit: int):
    nodes = []  # feature, threshold, left, right, size

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, len(idx)])
        if depth >= limit or len(idx) <= 1:
            return me
        sub = X[idx]
        lo, hi = sub.min(0), sub.max(0)
        cand = np.flatnonzero(hi > lo)
        if cand.size == 0:
            return me
        f = int(rng.choice(cand))
        thr = float(rng.uniform(lo[f], hi[f]))
        left = idx[sub[:, f] < thr]
        right = idx[sub[:, f] >= thr]
        nodes[me][0], nodes[me][1] = f, thr
        nodes[me][2] = build(left, depth + 1)
        nodes[me][3] = build(right, depth + 1)
        return me

    build(np.arange(X.shape[0]), 0)
    return nodes


def descent_table(feat, thr, left, right, adj) -> tuple:
    """A tree for ``path_lengths``: feature, threshold, the next node by (node, goes left),
    where a leaf leads to itself, path length at a leaf, levels."""
    leaf, me = feat < 0, np.arange(len(feat))
    depth = np.zeros(len(feat))
    for i in np.flatnonzero(~leaf):  # parents come before their children
        depth[[left[i], right[i]]] = depth[i] + 1
    after = np.column_stack([np.where(leaf, me, right), np.where(leaf, me, left)]).astype(np.intp).ravel()
    return np.where(leaf, 0, feat).astype(np.intp), thr.astype(np.float64), after, depth + adj, int(depth.max(initial=0))


def path_lengths(forest, X: np.ndarray) -> np.ndarray:
    """Sum of the path lengths of each row over the trees: all rows go down a level at a time."""
    values, start, total = np.ascontiguousarray(X).ravel(), np.arange(len(X)) * X.shape[1], np.zeros(len(X))
    for feat, thr, after, length, levels in forest:
        node = np.zeros(len(X), dtype=np.intp)
        for _ in range(levels):
            node = after[2 * node + (values[start + feat[node]] < thr[node])]
        total += length[node]
    return total


class IsolationForest:
    def __init__(self, cols: Sequence[str], trees: int = 100, sample: int = 256, contamination: float = 0.02,
                 seed: int = 42, key: str | None = None):
        self.key = key
        self.cols, self.trees, self.sample, self.contamination, self.seed = list(cols), trees, sample, contamination, seed

    def fit(self, df: DataFrame) -> "IsolationForestModel":
        n = df.count()
        psi = min(self.sample, n)
        # so many candidates that fewer than psi are drawn once in millions of trees
        share = min(1.0, (psi + 6.0 * math.sqrt(psi) + 6.0) / max(n, 1))
        cols, seed, limit = self.cols, self.seed, int(math.ceil(math.log2(max(psi, 2))))
        trees, names = self.trees, [f"c{i}" for i in range(len(cols))]
        row = F.xxhash64(F.col(self.key)) if self.key else F.xxhash64(*df.columns)
        rows = (df.select(*[F.col(c).cast("double").alias(m) for c, m in zip(cols, names)], row.alias("_row"))
                  .groupBy(*names, "_row").agg(F.count(F.lit(1)).alias("_copies")))

        def bottom(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best = [None] * trees  # the least draws of each tree among the task's rows
            for pdf in batches:
                r, c = pdf["_row"].to_numpy(np.int64), pdf["_copies"].to_numpy(np.int64)
                X = pdf[names].to_numpy(np.float64)
                first = first_bound(c, share)
                for t in range(trees):
                    at, u = draws(r, c, t, seed, share, first)
                    if len(at):
                        got = np.column_stack([u, X[at]])
                        got = got if best[t] is None else np.concatenate([best[t], got])
                        best[t] = got[np.argsort(got[:, 0], kind="stable")[:psi]]
            for t, got in enumerate(best):
                if got is not None:
                    yield pd.DataFrame(got, columns=["_r", *names]).assign(tree=np.int32(t))

        schema = "_r double, " + ", ".join(f"{m} double" for m in names) + ", tree int"
        drawn = rows.mapInPandas(bottom, schema)
        drawn = drawn.withColumn("_k", F.row_number().over(Window.partitionBy("tree").orderBy("_r", *names))) \
                     .where(F.col("_k") <= psi).drop("_k", "_r")

        def grow(pdf: pd.DataFrame) -> pd.DataFrame:
            t = int(pdf["tree"].iloc[0])
            rng = np.random.default_rng(seed * 100003 + t)
            X = pdf[names].to_numpy(np.float64)
            nodes = _grow(X, rng, limit)
            a = np.array(nodes, dtype=object)
            return pd.DataFrame({"tree": t, "node": np.arange(len(nodes), dtype=np.int32),
                                 "feature": a[:, 0].astype(np.int32), "threshold": a[:, 1].astype(np.float64),
                                 "left": a[:, 2].astype(np.int32), "right": a[:, 3].astype(np.int32),
                                 "size": a[:, 4].astype(np.int64)})

        forest = drawn.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).collect()  # the model: bounded nodes
        return IsolationForestModel(self, forest, psi)


class IsolationForestModel:
    def __init__(self, est: IsolationForest, nodes, psi: int):
        self.est, self.psi = est, psi
        by_tree = {}
        for r in nodes:
            by_tree.setdefault(r["tree"], []).append(r)
        self.forest = []
        for t in sorted(by_tree):
            rs = sorted(by_tree[t], key=lambda r: r["node"])
            feat, thr, left, right, size = (np.array([r[k] for r in rs]) for k in
                                            ("feature", "threshold", "left", "right", "size"))
            adj = np.array([c_factor(float(x)) for x in size])  # path-length credit of a leaf
            self.forest.append((feat, thr, left, right, adj))

    def score(self, df: DataFrame, out: str = "anomaly_score") -> DataFrame:
        spark = df.sparkSession
        bc = spark.sparkContext.broadcast(([descent_table(*tree) for tree in self.forest], self.psi))
        cols = self.est.cols
        schema = T.StructType(list(df.schema.fields) + [T.StructField(out, T.DoubleType(), True)])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            forest, psi = bc.value
            cn = c_factor(psi)
            for pdf in batches:
                total = path_lengths(forest, pdf[cols].to_numpy(np.float64))
                pdf[out] = np.power(2.0, -(total / len(forest)) / cn) if cn > 0 else 0.5
                yield pdf

        return df.mapInPandas(run, schema)

    def transform(self, df: DataFrame, flag: str = "is_outlier") -> DataFrame:
        # scores feed two passes (quantile, flag): write them once
        scored = materialize(self.score(df), "isoforest-scores")
        thr = quantile_values(scored, ["anomaly_score"], [1.0 - self.est.contamination], "linear")[
            ("anomaly_score", 1.0 - self.est.contamination)]
        return scored.withColumn(flag, F.col("anomaly_score") > F.lit(thr))
