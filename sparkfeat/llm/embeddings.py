"""Embedding near-duplicates by product quantisation (operator 1).

Links are pairs of vectors with cosine >= ``threshold`` in double precision.

*Index.*  Vectors are scaled to length 1; equal ones are one class.  Coarse centroids
(about the square root of the number of classes) and the codebooks of ``SUBSPACES``
residual subspaces are fitted on a bounded sample of classes (at most ``TRAIN``).  Centroids
closer than the linking radius, and chains of them, share one list: a large group of near
copies draws centroids in proportion to its size, and its links would run between more lists
than anyone probes.  Every class is filed in the inverted list of its nearest centroid with
one code a subspace and the length of what the codes miss.

*Search.*  Every class visits its ``PROBES`` nearest lists (by their nearest centroids).  Squared distances to the list's
members are sums of table entries, one a subspace (asymmetric: the visitor is not
quantised).  By the triangle inequality a member within the linking radius lies within
radius + missed length of the visitor by its codes, so no pair that meets in a list is
lost.  The rest are decided by the exact cosine, by a matrix product where they are many.

*Counting without pairs.*  A pair can meet in the list of either; it counts in the
smaller-numbered of the lists in which it does, so both ends count it once.  A task sends,
for each class of its block, the sum of its links and one smallest linked class; a list with
more than ``BLOCK`` entries is cut into blocks that meet pairwise.  Copies are counted by
class size.  Components come from the links' spanning edges.

Defined results: null, empty, zero vectors and vectors with null or non-finite components
link with nothing; vectors of different length never link; repeated rows are copies (linked
to each other); null ids are kept, counted as vectors and ignored in smallest ids; an empty
table gives an empty result; only the two named columns are read.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, parts_for, renamed, shared_keys
from .components import connected_components
from .jaccard import roots
from .textkit import mix

TRAIN = 32_768  # classes sampled to fit centroids and codebooks
LISTS = 4_096  # inverted lists at most
PROBES = 12
SUBSPACES = 8
CODES = 64
BLOCK = 8_192  # entries of a list compared in one task
DENSE = 32  # one candidate in so many pairs: exact cosines of all pairs at once
ENTRY_ROWS = 50_000  # entries a task of the comparison
ROUNDS = 8


def k_means(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of the rows of ``x``; starts from evenly spaced rows, so reruns agree."""
    k = min(k, len(x))
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = nearest(x, c, 1)[:, 0]
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        n = np.bincount(own, minlength=k)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def close_pairs(c: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of ``c`` closer than ``radius``."""
    square, a, b = (c * c).sum(axis=1), [], []
    for lo in range(0, len(c), 1024):
        d = square[lo:lo + 1024, None] + square - 2 * c[lo:lo + 1024] @ c.T
        i, j = np.nonzero(d < radius * radius)
        a.append(i[i + lo < j] + lo)
        b.append(j[i + lo < j])
    return np.concatenate(a), np.concatenate(b)


def nearest(x: np.ndarray, c: np.ndarray, m: int, first: np.ndarray | None = None) -> np.ndarray:
    """Indices of the m nearest rows of ``c``, nearest first, 4,096 rows at a time; with
    ``first``, of the m nearest runs of rows that begin there."""
    runs = len(c) if first is None else len(first)
    m = min(m, runs)
    out = np.empty((len(x), m), np.int64)
    square = (c * c).sum(axis=1)
    for lo in range(0, len(x), 4096):
        d = square - 2 * x[lo:lo + 4096] @ c.T
        if runs < len(c):
            d = np.minimum.reduceat(d, first, axis=1)
        if m == 1:
            out[lo:lo + 4096, 0] = d.argmin(axis=1)
            continue
        at = np.argpartition(d, m - 1, axis=1)[:, :m] if m < runs else np.tile(np.arange(m), (len(d), 1))
        order = np.argsort(np.take_along_axis(d, at, 1), axis=1, kind="stable")
        out[lo:lo + 4096] = np.take_along_axis(at, order, 1)
    return out


class Quantiser:
    def __init__(self, sample: np.ndarray, lists: int, radius: float = 0.0):
        self.dim = sample.shape[1]
        c = k_means(sample, lists)
        a, b = close_pairs(c, radius)
        own = np.unique(roots(len(c), a, b), return_inverse=True)[1] if len(a) else np.arange(len(c))
        order = np.argsort(own, kind="stable")
        self.fine = c[order]  # centroids, those of a list side by side
        self.first = np.searchsorted(own[order], np.arange(own.max() + 1))
        self.centroids = np.add.reduceat(self.fine, self.first) / np.diff(np.append(self.first, len(c)))[:, None]
        residual = sample - self.centroids[self.lists(sample, 1)[:, 0]]
        edge = np.linspace(0, self.dim, min(SUBSPACES, self.dim) + 1).astype(int)
        self.parts = list(zip(edge[:-1].tolist(), edge[1:].tolist()))
        self.books = [k_means(residual[:, a:b], CODES) for a, b in self.parts]

    def lists(self, x: np.ndarray, m: int) -> np.ndarray:
        """The m lists whose nearest centroids are nearest to each row, nearest first."""
        return nearest(x, self.fine, m, self.first)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(lists to probe, codes for the first of them, lengths that the codes miss)."""
        probes = self.lists(x, PROBES)
        r = x - self.centroids[probes[:, 0]]
        codes = np.stack([nearest(r[:, a:b], book, 1)[:, 0] for (a, b), book in zip(self.parts, self.books)], axis=1)
        back = np.concatenate([book[codes[:, s]] for s, book in enumerate(self.books)], axis=1)
        return probes, codes.astype(np.uint8), np.sqrt(((r - back) ** 2).sum(axis=1))

    def tables(self, x: np.ndarray, cell: int) -> np.ndarray:
        """Squared distances of a visitor's residual parts to all codewords."""
        r = x - self.centroids[cell]
        return np.stack([((r[:, a:b, None] - book.T[None]) ** 2).sum(axis=1) if b - a <= 4 else
                         (r[:, a:b] ** 2).sum(axis=1)[:, None] - 2 * r[:, a:b] @ book.T + (book ** 2).sum(axis=1)
                         for (a, b), book in zip(self.parts, self.books)], axis=1)


def _unit(flat: np.ndarray) -> np.ndarray:
    # divide by the largest entry first: squares of very large or small entries stay finite
    x = flat / np.abs(flat).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _key(u: np.ndarray, seed: int) -> np.ndarray:
    """64-bit keys (never 0) of the rows of ``u``."""
    place = mix(np.arange(u.shape[1], dtype=np.uint64), seed)
    key = mix(mix(u.view(np.uint64) ^ place, seed + 1).sum(axis=1, dtype=np.uint64), u.shape[1]).view(np.int64)
    return np.where(key == 0, 1, key)


def _keyed(bits: int):
    """(id, vector) -> (id, node, second, dim, unit): node 0 for vectors that link with nothing,
    else a key of ``bits`` bits; ``second`` is another key."""
    def run(batches):
        for batch in batches:
            node, second, dim = (np.zeros(len(batch), t) for t in (np.int64, np.int64, np.int32))
            unit, by_dim = [None] * len(batch), {}
            for i, v in enumerate(batch.column(1)):
                if not v.is_valid or len(v.values) == 0 or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all() and np.abs(x).max() > 0:
                    by_dim.setdefault(len(x), []).append((i, x))
            for d, rows in by_dim.items():
                at = np.array([i for i, _ in rows])
                u = _unit(np.stack([x for _, x in rows])) + 0.0  # no negative zeros
                key = _key(u, 31)
                node[at] = key if bits >= 64 else (key & ((1 << bits) - 1)) + 1
                second[at], dim[at] = _key(u, 33), d
                for i, x in zip(at.tolist(), u):
                    unit[i] = x.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(node), pa.array(second), pa.array(dim), pa.array(unit, pa.binary())],
                ["id", "node", "second", "dim", "unit"])
    return run


def _classes(rows: DataFrame) -> DataFrame:
    """The different vectors, by key."""
    return materialize(rows.where("node <> 0").groupBy("node").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.min("dim").alias("dim"), F.min("unit").alias("unit"),
        F.min("second").alias("low"), F.max("second").alias("high")), "vector-classes")


def _padded(units, width: int) -> np.ndarray:
    out = np.zeros((len(units), width))
    for i, u in enumerate(units):
        x = np.frombuffer(u, np.float64)
        out[i, :len(x)] = x
    return out


def _file(quantiser, width: int):
    def run(batches):
        q = quantiser.value
        for batch in batches:
            if len(batch) == 0:
                continue
            probes, codes, missed = q.encode(_padded(batch.column("unit").to_pylist(), width))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("copies"), batch.column("dim"), batch.column("unit"),
                 pa.array(list(probes.astype(np.int32)), pa.list_(pa.int32())),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(missed)],
                ["node", "copies", "dim", "unit", "probes", "codes", "missed"])
    return run


def _compare(quantiser, width: int, threshold: float):
    radius = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-7

    def block(q: Quantiser, cell: int, i: int, j: int, rows: dict) -> pa.RecordBatch | None:
        order = np.argsort(rows["node"], kind="stable")
        node, copies, dim, own, missed = (rows[k][order] for k in ("node", "copies", "dim", "own", "missed"))
        x = _padded([rows["unit"][k] for k in order], width)
        probes = np.stack([rows["probes"][k] for k in order])
        codes = np.stack([np.frombuffer(rows["codes"][k], np.uint8) for k in order]).astype(np.int64)
        member = np.flatnonzero(probes[:, 0] == cell)
        if len(member) == 0:
            return None
        links, root = np.zeros(len(node), np.int64), np.arange(len(node))
        offsets = np.arange(codes.shape[1]) * CODES
        flat = codes[member] + offsets
        for lo in range(0, len(node), 128):
            table = q.tables(x[lo:lo + 128], cell)
            if table.shape[2] < CODES:
                table = np.pad(table, ((0, 0), (0, 0), (0, CODES - table.shape[2])))
            table = table.reshape(len(table), -1)
            far = table[:, flat[:, 0]]
            for s in range(1, flat.shape[1]):
                far = far + table[:, flat[:, s]]
            near = far <= (radius + missed[member]) ** 2 + 1e-9
            dense = np.count_nonzero(near) * DENSE > near.size
            if dense:  # only what is on the edge is decided pair by pair
                cosine = x[lo:lo + 128] @ x[member].T
                near &= cosine >= threshold - 1e-9
            v, m = np.nonzero(near)
            open_ = cosine[v, m] < threshold + 1e-9 if dense else np.ones(len(v), bool)
            v, m = v + lo, member[m]
            both = probes[v, 0] == cell
            keep = (v < m) | ~both  # two members meet once
            keep &= (dim[v] == dim[m]) & ((own[v] != own[m]) | (i == j))
            v, m, open_ = v[keep], m[keep], open_[keep]
            for at in range(0, len(v), 1 << 16):
                a, b = v[at:at + (1 << 16)], m[at:at + (1 << 16)]
                ok = ~open_[at:at + (1 << 16)]
                k = np.flatnonzero(~ok)
                ok[k] = np.einsum("ij,ij->i", x[a[k]], x[b[k]]) >= threshold
                home = probes[a, 0]
                k = np.flatnonzero(ok & (home < cell))
                ok[k] = ~(probes[b[k]] == home[k, None]).any(axis=1)
                a, b = a[ok], b[ok]
                links += np.bincount(a, copies[b], len(node)).astype(np.int64)
                links += np.bincount(b, copies[a], len(node)).astype(np.int64)
                a, b = root[a], root[b]
                if (a != b).any():  # only the roots are kept, not the pairs
                    root = roots(len(node), a[a != b], b[a != b])[root]
        found = links > 0
        if not found.any():
            return None
        return pa.RecordBatch.from_arrays([pa.array(node[found]), pa.array(links[found]), pa.array(node[root][found])],
                                          ["node", "links", "root"])

    def run(batches):
        held: dict[tuple, list] = {}
        for batch in batches:
            cols = {n: batch.column(n) for n in batch.schema.names}
            key = np.stack([np.asarray(cols[c]) for c in ("cell", "i", "j")], axis=1)
            for k in np.unique(key, axis=0):
                at = np.flatnonzero((key == k).all(axis=1))
                held.setdefault(tuple(k.tolist()), []).append(batch.take(pa.array(at)))
        for key in list(held):
            part = pa.Table.from_batches(held.pop(key))
            rows = {n: part.column(n).to_numpy() for n in ("node", "copies", "dim", "own", "missed")}
            rows["unit"], rows["codes"] = part.column("unit").to_pylist(), part.column("codes").to_pylist()
            rows["probes"] = np.asarray(part.column("probes").to_pylist())
            out = block(quantiser.value, *key, rows)
            if out is not None:
                yield out
    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = 0.95, key_bits: int = 64) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.  Equal vectors are one
    node, named by a key of ``key_bits`` bits (fewer than 64 are for tests), or by a second
    key where different vectors share the first."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    kind = rows.schema["id"].dataType.simpleString()
    rows = materialize(rows.mapInArrow(_keyed(key_bits), f"id {kind}, node long, second long, dim int, unit binary"),
                       "vectors")
    classes = _classes(rows)
    shared = shared_keys(classes, "node", "low", "high")
    if shared:
        rows = renamed(rows, "node", "second", shared)
        classes = _classes(rows)
    n, width = classes.agg(F.count("*"), F.max("dim")).first()
    if not n:
        own = F.col("id")
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), own.alias("component_id"), F.lit(True).alias("kept"))

    share = min(1.0, TRAIN / n)
    sample = classes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).orderBy("node").limit(TRAIN)
    units = [bytes(r["unit"]) for r in sample.select("unit").collect()] or [bytes(classes.first()["unit"])]
    quantiser = spark.sparkContext.broadcast(Quantiser(
        _padded(units, width), max(1, min(LISTS, round(math.sqrt(n)))), math.sqrt(max(0.0, 2 - 2 * threshold))))

    filed = materialize(classes.select("node", "copies", "dim", "unit").mapInArrow(
        _file(quantiser, width),
        "node long, copies long, dim int, unit binary, probes array<int>, codes binary, missed double"), "vector-lists")
    entries = filed.withColumn("cell", F.explode("probes"))
    blocks = materialize(entries.groupBy("cell").agg(F.count("*").alias("n"))  # a row a list
                         .select("cell", "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("of")), "vector-blocks")
    spread = blocks.agg(F.sum(F.col("n") * F.col("of"))).first()[0]
    entries = (entries.join(F.broadcast(blocks.drop("n")), "cell").withColumn("own", F.pmod(F.xxhash64("node"), F.col("of")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1))))
    grid = entries.select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                          "own", "node", "copies", "dim", "unit", "probes", "codes", "missed")
    parts = max(parts_for(vectors, 8 << 20), min(LISTS, round(math.sqrt(n))) // 4, spread // ENTRY_ROWS)
    found = materialize(grid.repartition(parts, "cell", "i", "j").mapInArrow(
        _compare(quantiser, width, threshold), "node long, links long, root long"), "vector-links")

    labels = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (classes.select("node", "id", "copies").join(sums, "node", "left").join(labels, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    smallest = named.groupBy("root").agg(F.min("id").alias("component_id"))
    named = materialize(named.join(smallest, "root").select(
        F.col("node").alias("c"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"),
        "vector-components")
    out = rows.join(named, F.col("node") == F.col("c"), "left")
    component = F.when(F.col("node") == 0, F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op1_pq_neardup(spark, sf_dir):
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.withColumnRenamed("id", "vec_id")


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(e) > 0
        AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.95 END),
c AS (SELECT vec_id, vec_id AS root FROM v
      UNION SELECT l.b, c.root FROM c JOIN l ON l.a = c.vec_id),
m AS (SELECT vec_id, min(root) AS component_id FROM c GROUP BY vec_id),
k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT m.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, m.vec_id = component_id AS kept
FROM m LEFT JOIN k ON k.a = m.vec_id
"""
