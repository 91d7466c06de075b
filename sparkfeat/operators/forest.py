"""Random forests of deep trees, grown where their rows are.

Spark's forest sends the statistics of every open node (features x bins x classes) through a
shuffle and keeps all nodes as objects on the driver; on labels that are hard to learn a tree
has about as many nodes as rows.  ``Forest`` takes the same parameters and grows the same kind
of tree (binned thresholds, a draw of features a node, Poisson bootstrap, gini, children of
one prediction merged) otherwise:

* equal rows are one row with a count, values become bin numbers, kept in blocks of rows (a
  byte a value);
* nodes of more rows than a task takes are split by histograms summed over the blocks, level
  by level for all trees; the rows of every smaller node go to one task, which grows the whole
  subtree level by level in numpy;
* a tree is a few arrays: nine bytes a node, and the class weights of its leaves.

A node's features are drawn by its place in the tree, a row's weight by its values (copies are
drawn for themselves: their weights' sum is).  So a tree does not depend on how many others
there are or on how the rows are partitioned, and a less deep tree is a deeper one cut off: candidates of a grid that differ in trees and depth alone are
cuts of one forest (``fitMultiple``)."""
from __future__ import annotations

import threading
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.base import _FitMultipleIterator
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

LOCAL_VALUES = 16_000_000  # binned values of a node that one task grows on
CELLS = 1 << 19  # cells of a level's statistics at once
TREE = ("feature", "split", "left", "leaf", "cls", "weight")
KINDS = (np.int32, np.uint16, np.int32, np.int32, np.int32, np.int64)
LOG_FACTORIALS = np.r_[0.0, np.cumsum(np.log(np.arange(1, 200)))]


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 of unsigned numbers."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _root(seed: int, tree: int) -> np.ndarray:
    return _mix(_mix(np.array([seed % 2**64], dtype=np.uint64)) + np.uint64(tree % 2**64))


def _children(ids: np.ndarray) -> np.ndarray:
    return np.stack([_mix(ids + np.uint64(1)), _mix(ids + np.uint64(2))], 1).ravel()


def draw(ids: np.ndarray, dims: int, m: int) -> np.ndarray:
    """``m`` different features for every node, by its number."""
    some = np.tile(np.arange(dims, dtype=np.int32), (len(ids), 1))
    if m >= dims:
        return some
    rows, state = np.arange(len(ids)), ids
    for s in range(m):
        state = _mix(state)
        at = s + ((state >> np.uint64(11)) % np.uint64(dims - s)).astype(np.int64)
        taken = some[rows, at]
        some[rows, at] = some[:, s]
        some[:, s] = taken
    return some[:, :m]


def bag(number: np.ndarray, hashes: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """How often every row is drawn for a tree: Poisson with the row's mean, by its hash and the
    tree's number (from a mean of 64 on the normal law, rounded)."""
    h = _mix(hashes.view(np.uint64) ^ number)
    u = ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
    out = np.zeros(len(u), dtype=np.int64)
    few = mean < 64
    for m in np.unique(mean[few]):
        own = mean == m
        out[own] = np.searchsorted(np.cumsum(np.exp(np.arange(200) * np.log(m) - m - LOG_FACTORIALS)), u[own])
    if not few.all():
        v = (_mix(h[~few]) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        z = np.sqrt(-2 * np.log(u[~few])) * np.cos(2 * np.pi * v)
        out[~few] = np.maximum(np.rint(mean[~few] + np.sqrt(mean[~few]) * z), 0)
    return np.minimum(out, 2**31 - 1).astype(np.int32)


def _gains(sl, sr, wl, total):
    """Of every threshold: the children's sums of squares over their weights."""
    wr = total[:, None] - wl
    ok = (wl > 0) & (wr > 0)
    return np.where(ok, sl / np.where(ok, wl, 1.0) + sr / np.where(ok, wr, 1.0), -np.inf)


def best_of_counts(counts: np.ndarray):
    """(score, bin) of the best threshold of each node, from counts [node, bin, class]."""
    below = counts.cumsum(1)
    total = below[:, -1:]
    above = total - below
    score = _gains((below * below).sum(2), (above * above).sum(2), below.sum(2), total[:, 0].sum(1))
    at = score.argmax(1)
    return score[np.arange(len(at)), at], at


def best_splits(X, at, g, y, w, counts, feats, bins):
    """(feature or -1, bin) of every node.  Row ``at[i]`` of the bin numbers ``X`` lies in node
    ``g[i]`` with class ``y[i]`` and weight ``w[i]``; ``counts``: weight by node and class."""
    G, k = counts.shape
    total, square = counts.sum(1), (counts * counts).sum(1)
    best = square / total * (1 + 1e-12)  # what is no gain is no split
    feature, split = np.full(G, -1, dtype=np.int32), np.zeros(G, dtype=np.uint16)
    dense = G * bins * k <= 4 * len(at)
    flat, first, wide = X.ravel(), at * X.shape[1], counts.ravel()
    bits = int(w.max()).bit_length()
    for s in range(feats.shape[1]):
        f = feats[:, s]
        b = flat[first + f[g]].astype(np.int64)
        if dense:
            score, t = best_of_counts(np.bincount((g * bins + b) * k + y, w, G * bins * k).reshape(G, bins, k))
        else:
            # by node, class and bin: what a row adds to its side's sum of squares follows from the
            # weight of its class that went before it
            key = np.sort((((g * k + y) * bins + b) << bits) | w)
            v, key = (key & ((1 << bits) - 1)).astype(np.float64), key >> bits
            gy = key // bins
            before = np.cumsum(v) - v
            start = np.ones(len(gy), dtype=bool)
            start[1:] = gy[1:] != gy[:-1]
            before -= np.maximum.accumulate(np.where(start, before, 0.0))
            cell = gy // k * bins + key % bins
            sums = lambda x: np.bincount(cell, x, G * bins).reshape(G, bins).cumsum(1)
            score = _gains(sums(v * (2 * before + v)), square[:, None] + sums(v * (v - 2 * (wide[gy] - before))), sums(v), total)
            t = score.argmax(1)
            score = score[np.arange(G), t]
        better = score > best
        best[better], feature[better], split[better] = score[better], f[better], t[better]
    return feature, split


def grow(X: np.ndarray, y: np.ndarray, w: np.ndarray, ids: np.ndarray, level: int, depth: int, bins: int, k: int, m: int):
    """The tree of some rows from a node of number ``ids[0]`` at ``level`` on: arrays ``TREE``.
    A node's children are ``left`` and the next; the last three arrays list the leaves' weights."""
    at, g = np.arange(len(y)), np.zeros(len(y), dtype=np.int64)
    y, w = y.astype(np.int64), w.astype(np.int64)
    nodes, records, base = [], [], 0
    while len(ids):
        G = len(ids)
        feature, split, left = np.full(G, -1, dtype=np.int32), np.zeros(G, dtype=np.uint16), np.zeros(G, dtype=np.int32)
        some = max(1, CELLS // max(bins, k))
        for lo in range(0, G, some):
            own = slice(lo, min(lo + some, G))
            here = (g >= lo) & (g < lo + some) if G > some else slice(None)
            a, h, c, v = at[here], g[here] - lo, y[here], w[here]
            counts = np.bincount(h * k + c, v, (own.stop - lo) * k).reshape(-1, k)
            open_ = (counts > 0).sum(1) > 1
            if level < depth and open_.any():
                place, rows = np.cumsum(open_) - 1, open_[h]
                feats = draw(ids[own][open_], X.shape[1], m)
                feature[lo + np.flatnonzero(open_)], split[lo + np.flatnonzero(open_)] = best_splits(
                    X, a[rows], place[h[rows]], c[rows], v[rows], counts[open_], feats, bins)
            leaf = np.flatnonzero(feature[own] < 0)
            n, c = np.nonzero(counts[leaf])
            records.append((base + lo + leaf[n], c, counts[leaf][n, c]))
        inner = feature >= 0
        rank = np.cumsum(inner) - 1
        left[inner] = base + G + 2 * rank[inner]
        nodes.append((feature, split, left))
        stay = inner[g]
        at, g, y, w = at[stay], g[stay], y[stay], w[stay]
        g = 2 * rank[g] + (X[at, feature[g]] > split[g])
        ids, base, level = _children(ids[inner]), base + G, level + 1
    return tuple(np.concatenate(x).astype(t) for x, t in zip([*zip(*nodes), *zip(*records)], KINDS))


def _kids(left: np.ndarray, inner: np.ndarray) -> np.ndarray:
    return (left[inner][:, None] + np.arange(2)).ravel()


def _summed(node, cls, weight, k):
    key, back = np.unique(node.astype(np.int64) * k + cls, return_inverse=True)
    return key // k, key % k, np.bincount(back, weight, len(key)).astype(np.int64)


def cut(tree, depth: int, k: int):
    """A tree cut off at ``depth``; leaves of one prediction that have one parent are merged."""
    feature, split, left, node, cls, weight = tree
    levels, to = [np.zeros(1, dtype=np.int64)], np.arange(len(feature))
    leaf = feature < 0
    while len(levels) <= depth and not leaf[levels[-1]].all():
        levels.append(_kids(left, levels[-1][~leaf[levels[-1]]]))
    below = levels[-1][~leaf[levels[-1]]]  # nodes at the cut, and then what lies under them
    leaf[below] = True
    owner = below
    while len(below):
        below, owner = _kids(left, below), np.repeat(owner, 2)
        to[below] = owner
        inner = feature[below] >= 0
        below, owner = below[inner], owner[inner]
    node, cls, weight = _summed(to[node], cls, weight, k)
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    top = np.flatnonzero(weight == np.repeat(np.maximum.reduceat(weight, first), np.diff(np.r_[first, len(node)])))
    pred = np.full(len(feature), -1)
    pred[node[top[::-1]]] = cls[top[::-1]]  # the first of equal ones
    to = np.arange(len(feature))
    for nodes in levels[-2::-1]:
        inner = nodes[~leaf[nodes]]
        l = left[inner]
        same = leaf[l] & leaf[l + 1] & (pred[l] == pred[l + 1])
        inner, l = inner[same], l[same]
        leaf[inner], pred[inner], to[l], to[l + 1] = True, pred[l], inner, inner
    while not np.array_equal(node, to[node]):
        node = to[node]
    levels = [np.zeros(1, dtype=np.int64)]
    while len(kids := _kids(left, levels[-1][~leaf[levels[-1]]])):
        levels.append(kids)
    kept = np.concatenate(levels)
    new = np.zeros(len(feature), dtype=np.int64)
    new[kept] = np.arange(len(kept))
    out = leaf[kept]
    return tuple(x.astype(t) for x, t in zip((np.where(out, -1, feature[kept]), np.where(out, 0, split[kept]),
                                              np.where(out, 0, new[left[kept]]), *_summed(new[node], cls, weight, k)), KINDS))


def votes(trees, thresholds: np.ndarray, X: np.ndarray, k: int) -> np.ndarray:
    """Sum over the trees of the class shares of each row's leaf."""
    out = np.zeros(len(X) * k)
    for feature, split, left, node, cls, weight in trees:
        bound = thresholds[feature, split]
        at, live = np.zeros(len(X), dtype=np.int64), np.arange(len(X))
        while True:
            live = live[feature[at[live]] >= 0]
            if not len(live):
                break
            a = at[live]
            at[live] = left[a] + ~(X[live, feature[a]] <= bound[a])
        n = np.bincount(node, minlength=len(feature))
        share = weight / np.bincount(node, weight, len(feature))[node]
        many = n[at]
        end = np.cumsum(many)
        from_ = np.repeat((np.cumsum(n) - n)[at] - (end - many), many) + np.arange(end[-1] if len(end) else 0)
        out += np.bincount(np.repeat(np.arange(len(X)), many) * k + cls[from_], share[from_], len(out))
    return out.reshape(-1, k)


def thresholds_of(values: np.ndarray, counts: np.ndarray, bins: int) -> list[float]:
    """At most bins - 1 thresholds between distinct values that leave about equal counts."""
    x, back = np.unique(values, return_inverse=True)
    n = np.bincount(back, counts)
    if len(x) <= bins:
        return ((x[:-1] + x[1:]) / 2).tolist()
    out, count, stride = [], 0, n.sum() / bins
    target = stride
    for i in range(1, len(x)):
        count += int(n[i - 1])
        if abs(count - target) < abs(count + int(n[i]) - target):
            out.append(float((x[i - 1] + x[i]) / 2))
            target += stride
    return out[:bins - 1]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    X = column.flatten().to_numpy(zero_copy_only=False)
    if len(X) != len(column) * dims:
        raise ValueError(f"every row needs {dims} features")
    return X.reshape(-1, dims)


def _stitch(top, parts):
    """A tree (of lists) and the subtrees that grew on some of its leaves, {leaf: tree}, as one."""
    feature, split, left, *records = (np.array(x, dtype=t) for x, t in zip(top, KINDS))
    pieces, n = [], len(feature)
    for o, (f, s, l, node, cls, weight) in sorted(parts.items()):
        l = np.where(f >= 0, l + n - 1, 0).astype(np.int32)  # its root takes the leaf's place
        feature[o], split[o], left[o] = f[0], s[0], l[0]
        pieces.append((f[1:], s[1:], l[1:], np.where(node > 0, node + n - 1, o).astype(np.int32), cls, weight))
        n += len(f) - 1
    return tuple(np.concatenate(x) for x in zip((feature, split, left, *records), *pieces))


def _place(top, X: np.ndarray) -> np.ndarray:
    """The leaf of the upper tree in which each row of bin numbers lies."""
    feature, split, left = (np.array(x, dtype=np.int64) for x in top[:3])
    at, live = np.zeros(len(X), dtype=np.int64), np.arange(len(X))
    while len(live := live[feature[at[live]] >= 0]):
        a = at[live]
        at[live] = left[a] + (X[live, feature[a]] > split[a])
    return at


def _summary(d: DataFrame) -> tuple[int, int, int]:
    """Rows, features and classes; labels and features are checked."""
    bad = F.col("y").isNull() | F.isnan("y") | (F.col("y") < 0) | (F.col("y") != F.floor("y"))
    r = d.agg(F.count(F.lit(1)).alias("n"), F.max("y").alias("y"), F.max(F.size("x")).alias("dims"), F.min(F.size("x")).alias("least"),
              F.count_if(bad).alias("labels"), F.count_if(F.col("x").isNull() | F.exists("x", F.isnan)).alias("values")).first()
    if not r["n"] or r["labels"] or r["values"] or r["least"] != r["dims"]:
        raise ValueError(f"a forest needs whole labels from 0 on and feature vectors of one length without NaN: {r}")
    return r["n"], r["dims"], int(r["y"]) + 1


def _thresholds(d: DataFrame, n: int, dims: int, bins: int, number: np.ndarray) -> np.ndarray:
    """Candidate thresholds [feature, bin], from a sample as large as Spark's trees take."""
    share = min(1.0, max(bins * bins, 10_000) / n)

    def some(batches):
        for batch in batches:
            c = batch.column(3).to_numpy()
            w = c if share == 1.0 else bag(number, batch.column(2).to_numpy(), c * share)
            X = _matrix(batch.column(0), dims)[w > 0]
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(dims, dtype=np.int32), len(X))), pa.array(X.ravel()),
                                              pa.array(np.repeat(w[w > 0], dims).astype(np.int64))], names=["f", "v", "c"])

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"f": [int(pdf["f"].iloc[0])], "t": [thresholds_of(pdf["v"].to_numpy(), pdf["c"].to_numpy(), bins)]})

    out = np.full((dims, max(bins - 1, 1)), np.inf)
    for r in d.mapInArrow(some, "f int, v double, c long").groupBy("f").applyInPandas(one, "f int, t array<double>").collect():
        out[r["f"], :len(r["t"])] = r["t"]
    return out


def _blocks(d: DataFrame, thresholds: np.ndarray) -> DataFrame:
    """(n, y, h, c, x): classes, hashes, counts and bin numbers of up to an Arrow batch of rows."""
    dims, kind = len(thresholds), np.uint8 if thresholds.shape[1] < 256 else np.uint16
    known = [t[np.isfinite(t)] for t in thresholds]

    def pack(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            X = _matrix(batch.column(0), dims)
            b = np.stack([np.searchsorted(t, X[:, j]) for j, t in enumerate(known)], 1).astype(kind)
            parts = (batch.column(1).to_numpy().astype(np.int32), batch.column(2).to_numpy(), batch.column(3).to_numpy(), b)
            yield pa.RecordBatch.from_arrays([pa.array([len(b)], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in parts)],
                                             names=["n", "y", "h", "c", "x"])

    return materialize(d.mapInArrow(pack, "n int, y binary, h binary, c binary, x binary"), "forest-blocks")


class Grown:
    """Trees as they grew, with what they rest on; ``shared`` sends them to the tasks once."""

    def __init__(self, trees: list, thresholds: np.ndarray, k: int):
        self.trees, self.thresholds, self.k = trees, thresholds, k
        self._lock, self._shared = threading.Lock(), None

    def shared(self, spark):
        with self._lock:
            if self._shared is None:
                self._shared = spark.sparkContext.broadcast((self.trees, self.thresholds))
            return self._shared


def grow_forest(df: DataFrame, features: str, label: str, trees: int, depth: int, bins: int, seed: int, rate: float = 1.0,
                draws=lambda dims: int(np.ceil(np.sqrt(dims)))) -> Grown:
    """``trees`` trees of ``depth`` at most, on a vector column and a label column (double)."""
    d = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    n, dims, k = _summary(d)
    d = d.groupBy("x", "y").agg(F.count(F.lit(1)).alias("c")).select("x", "y", F.xxhash64("x", "y").alias("h"), "c").cache()
    thresholds = _thresholds(d, n, dims, min(bins, n), _root(seed, -1))
    bins, m = thresholds.shape[1] + 1, min(dims, max(1, draws(dims))) if trees > 1 else dims
    kind = np.uint8 if bins <= 256 else np.uint16
    blocks = _blocks(d, thresholds)
    d.unpersist()
    most = max(1, LOCAL_VALUES // dims)  # drawn rows that a task grows on
    tops = [([-1], [0], [0], [], [], []) for _ in range(trees)]
    # open leaves of the upper trees: (tree, node) -> (number, level, drawn rows)
    todo = {(t, 0): (_root(seed, t), 0, n * rate) for t in range(trees)}

    def rows_of(row, t, wanted):
        X = np.frombuffer(row.x, kind).reshape(row.n, dims)
        y, h, c = (np.frombuffer(x, kd) for x, kd in ((row.y, np.int32), (row.h, np.int64), (row.c, np.int64)))
        w = bag(_root(seed, t), h, c * rate)
        at = _place(tops[t], X)
        for node in wanted:
            own = (at == node) & (w > 0)
            if own.any():
                yield node, X[own], y[own], w[own]

    while big := {key: v for key, v in todo.items() if v[2] > most}:
        by_tree = {t: [node for tree, node in big if tree == t] for t, _ in big}

        def count(frames):
            sums: dict = {}
            for frame in frames:
                for row in frame.itertuples():
                    for t, wanted in by_tree.items():
                        for node, X, y, w in rows_of(row, t, wanted):
                            feats = draw(big[t, node][0], dims, m)[0]
                            cell = (np.arange(m) * bins + X[:, feats]) * k + y[:, None]
                            c = np.bincount(cell.ravel(), np.repeat(w, m), m * bins * k).astype(np.int64)
                            sums[t, node] = sums[t, node] + c if (t, node) in sums else c
            for (t, node), c in sums.items():
                yield pd.DataFrame({"tree": [t], "node": [node], "c": [c.tobytes()]})

        def choose(key, pdf):
            t, node = map(int, key)
            c = sum(np.frombuffer(x, np.int64) for x in pdf["c"]).reshape(m, bins, k).astype(np.float64)
            total = c[0].sum(0)
            best, feature, split = (total * total).sum() / total.sum() * (1 + 1e-12), -1, 0
            score, at = best_of_counts(c)
            number, level, _ = big[t, node]
            for s in range(m) if level < depth else ():
                if score[s] > best:
                    best, feature, split = score[s], int(draw(number, dims, m)[0, s]), int(at[s])
            below = c[list(draw(number, dims, m)[0]).index(feature), :split + 1].sum() if feature >= 0 else 0.0
            return pd.DataFrame({"tree": [t], "node": [node], "feature": [feature], "split": [split], "below": [below], "total": [total]})

        found = (blocks.mapInPandas(count, "tree int, node int, c binary").groupBy("tree", "node")
                 .applyInPandas(choose, "tree int, node int, feature int, split int, below double, total array<double>").collect())
        for r in found:
            (number, level, _), (feature, split, left, *records) = todo.pop((r["tree"], r["node"])), tops[r["tree"]]
            if r["feature"] < 0:
                for c, v in enumerate(r["total"]):
                    if v:
                        for have, x in zip(records, (r["node"], c, v)):
                            have.append(x)
                continue
            at, kids = len(feature), _children(number)
            feature[r["node"]], split[r["node"]], left[r["node"]] = r["feature"], r["split"], at
            for have, x in zip((feature, split, left), (-1, 0, 0)):
                have += [x, x]
            todo[r["tree"], at] = kids[:1], level + 1, r["below"]
            todo[r["tree"], at + 1] = kids[1:], level + 1, sum(r["total"]) - r["below"]
    nodes = {t: [node for tree, node in todo if tree == t] for t, _ in todo}

    def deal(frames):
        for frame in frames:
            for row in frame.itertuples():
                for t, wanted in nodes.items():
                    if own := [(t, node, len(y), y.tobytes(), w.tobytes(), X.tobytes()) for node, X, y, w in rows_of(row, t, wanted)]:
                        yield pd.DataFrame(own, columns=["tree", "node", "n", "y", "w", "x"])

    def subtree(key, pdf):
        t, node = map(int, key)
        number, level, _ = todo[t, node]
        X, y, w = (np.frombuffer(b"".join(pdf.pop(c)), x) for c, x in (("x", kind), ("y", np.int32), ("w", np.int32)))
        out = grow(X.reshape(-1, dims), y, w, number, level, depth, bins, k, m)
        return pd.DataFrame({"tree": [t], "node": [node]} | {c: [x.tobytes()] for c, x in zip(TREE, out)})

    # a group is minutes of work in few bytes: as many partitions as keep most groups apart
    dealt = blocks.mapInPandas(deal, "tree int, node int, n int, y binary, w binary, x binary").repartition(4 * len(todo) or 1, "tree", "node")
    grown = materialize(dealt.groupBy("tree", "node").applyInPandas(
        subtree, "tree int, node int, " + ", ".join(f"{c} binary" for c in TREE)), "forest-trees")
    parts: dict = {t: {} for t in range(trees)}
    for r in grown.toLocalIterator():
        parts[r["tree"]][r["node"]] = tuple(np.frombuffer(r[c], x) for c, x in zip(TREE, KINDS))
    for (t, node), _ in todo.items():  # a bootstrap that drew no row: Spark predicts class 0
        parts[t].setdefault(node, tuple(np.array([x], dtype=kd) for x, kd in zip((-1, 0, 0, 0, 0, 1), KINDS)))
    return Grown([_stitch(top, parts.pop(t)) for t, top in enumerate(tops)], thresholds, k)


class ForestModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, MLWritable, MLReadable):
    """The first ``trees`` trees of a grown forest, cut off at ``depth``."""

    def __init__(self, grown: Grown | None = None, trees: int = 0, depth: int = 0):
        super().__init__()
        self.grown, self.trees, self.depth = grown, trees, depth

    def own_trees(self) -> list:
        return [cut(t, self.depth, self.grown.k) for t in self.grown.trees[:self.trees]]

    @property
    def totalNumNodes(self) -> int:
        return sum(len(t[0]) for t in self.own_trees())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared, n, depth, k = self.grown.shared(dataset.sparkSession), self.trees, self.depth, self.grown.k

        @F.arrow_udf("array<double>")
        def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            trees, thresholds = shared.value
            trees = [cut(t, depth, k) for t in trees[:n]]
            for column in columns:
                v = votes(trees, thresholds, _matrix(column, len(thresholds)), k)
                yield pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * k, pa.int32()), pa.array(v.ravel()))

        raw = F.col("_votes")
        return (dataset.withColumn("_votes", score(vector_to_array(self.getFeaturesCol())))
                .withColumns({self.getRawPredictionCol(): array_to_vector(raw),
                              self.getProbabilityCol(): array_to_vector(F.transform(raw, lambda x: x / n)),
                              self.getPredictionCol(): (F.array_position(raw, F.array_max(raw)) - 1).cast("double")}).drop("_votes"))

    def write(self):
        return _ForestWriter(self)

    @classmethod
    def read(cls):
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, spark = self.model, self.sparkSession
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={"trees": m.trees, "depth": m.depth, "classes": m.grown.k})
        spark.createDataFrame([(j, t.tolist()) for j, t in enumerate(m.grown.thresholds)], "feature int, bounds array<double>").write.parquet(f"{path}/thresholds")
        rows = [(i, *(x.tobytes() for x in t)) for i, t in enumerate(m.own_trees())]
        spark.createDataFrame(rows, "tree int, " + ", ".join(f"{c} binary" for c in TREE)).write.parquet(f"{path}/trees")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        bounds = sorted((r["feature"], r["bounds"]) for r in spark.read.parquet(f"{path}/thresholds").collect())
        trees = {r["tree"]: tuple(np.frombuffer(r[c], x) for c, x in zip(TREE, KINDS)) for r in spark.read.parquet(f"{path}/trees").toLocalIterator()}
        model = ForestModel(Grown([trees[i] for i in range(metadata["trees"])], np.array([b for _, b in bounds]), metadata["classes"]), metadata["trees"], metadata["depth"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class Forest(RandomForestClassifier):
    """Spark's random forest classifier by its parameters, grown by ``grow_forest``."""

    def _group(self) -> tuple:
        """What two candidates must share to be cuts of one forest."""
        if (self.getImpurity(), self.getMinInstancesPerNode(), self.getMinInfoGain(), self.getMinWeightFractionPerNode(), self.getBootstrap()) \
                != ("gini", 1, 0.0, 0.0, True) or self.isDefined(self.weightCol) or self.getFeatureSubsetStrategy() not in ("auto", "all"):
            raise ValueError("not a parameter of this forest")
        return (self.getFeaturesCol(), self.getLabelCol(), self.getMaxBins(), self.getSeed(), self.getSubsamplingRate(),
                self.getFeatureSubsetStrategy(), self.getNumTrees() > 1)

    def _grow(self, dataset: DataFrame, trees: int, depth: int) -> Grown:
        every = (lambda dims: dims,) if self.getFeatureSubsetStrategy() == "all" else ()
        return grow_forest(dataset, self.getFeaturesCol(), self.getLabelCol(), trees, depth, self.getMaxBins(), self.getSeed(),
                           self.getSubsamplingRate(), *every)

    def _model(self, grown: Grown) -> ForestModel:
        return self._copyValues(ForestModel(grown, self.getNumTrees(), self.getMaxDepth()))

    def _fit(self, dataset: DataFrame) -> ForestModel:
        self._group()
        return self._model(self._grow(dataset, self.getNumTrees(), self.getMaxDepth()))

    def fitMultiple(self, dataset: DataFrame, paramMaps):
        """A model for each map, equal to the one that it gets alone; those that differ in trees
        and depth only are cut from one forest of the most trees and the greatest depth."""
        ests = [self.copy(p) for p in paramMaps]
        groups: dict = {}
        for e in ests:
            groups.setdefault(e._group(), []).append(e)
        grown: dict = {key: None for key in groups}
        locks = {key: threading.Lock() for key in groups}

        def one(i: int) -> ForestModel:
            key = ests[i]._group()
            with locks[key]:
                if grown[key] is None:
                    grown[key] = ests[i]._grow(dataset, max(e.getNumTrees() for e in groups[key]), max(e.getMaxDepth() for e in groups[key]))
            return ests[i]._model(grown[key])

        return _FitMultipleIterator(one, len(ests))
