"""N-gram Jaccard join by PartEnum signatures (operator 8).

Two texts link when |A n B| / |A u B| >= ``num/den`` over their sets of distinct
5-word shingles (``[^\\x20\\x09-\\x0D]+`` words, A-Z lower-cased).

*Bands.*  Set sizes are cut into bands [L, m].  A pair whose smaller set lies in a band
has its larger set at most m*den/num, and differs in at most k = m*(den-num)/num
elements, so both sets are members of that band's window: a set belongs to its own
band and to the one or two bands below whose window reaches its size.

*Partitions and subsets.*  A window deals the shingle domain into n1 partitions.  At
most k of them differ between linked sets.  A set with N non-empty partitions therefore
agrees with any partner on N-k of them; putting them in one global order, the t
smallest that agree are among the first k+t of either set, so each set enumerates the
t-subsets of its first k+t partitions, and linked sets share one signature (t is 2 for
small sets, whose single partitions tell little, else 1).  n1 is chosen to give N >= k+t
with room; a set that misses it also enumerates single elements as partitions, and two
such sets meet there.  Common passages come last in the global order: partitions whose
shingles were all seen in several texts of a bounded sample, and the room lets most sets
do without them.  The order is free, so the sample affects the work, never the result.

*Candidates.*  Signatures travel as packed arrays, 4 bytes a signature, into hash
buckets; a bucket emits, for each signature that several sets share, its members once.
Members carry a parity bitmap (2 bits a shingle; the distance of two bitmaps never exceeds
that of the sets).  Pairs that sizes and bitmaps allow make up clusters; only spanning edges
of them leave a task, never pairs.  A tight group costs one comparison a member: what is
connected is not compared again.

*Verification.*  The texts of clustered sets are read once more; a cluster's full sets meet in
blocks of bounded rows and bytes, where intersection sizes of all pairs come from a matrix
product over the shingles they share.  Exact links leave as spanning edges, whose components
are the result.

Equal sets are one node, so copies are never expanded.  A node's name is a 64-bit key of its
set; where a second key shows that different sets share a name, they go by the second key.  Defined results: null or
wordless text has size 0 and links with nothing; null ids are kept (they take the
component's smallest non-null id); repeated rows give repeated rows; an empty table
gives an empty result.  Only the two named columns are read.
"""
from __future__ import annotations

import bisect
import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap, fresh, materialize, maybe, parts_for, renamed, shared_keys, trimmed, wide_key
from .components import connected_components
from .textkit import mix, shingle_sets

HOT_SAMPLE = 8_000  # texts sampled for the order of partitions, by a hash (within a few hundred)
HOT_LEAST = 3  # a shingle of so many of them is common
HOT_LIMIT = 1 << 18  # common shingles taken at most
HOT_BITS = 1 << 22  # of the bitmap that holds them in every task
ROOM = 1.3  # non-empty partitions aimed at, as a multiple of those needed
FLUSH = 1 << 19  # signatures packed at a time
BLOCK = 2_048  # members of a signature compared at a time
SMALL = 48  # groups up to this size are compared pair by pair, many groups at a time
PAIRS = 1 << 20  # pairs of indices held at a time
SET_ROWS, SET_BYTES = 1_024, 16 << 20  # of a cluster's block of full sets
DENSE = 32  # a shingle of more sets of a block goes through the matrix product


class Bands:
    """Windows over set sizes for a similarity of num/den."""

    def __init__(self, num: int = 75, den: int = 100):
        if not 0 < num <= den:
            raise ValueError("the similarity must be in (0, 1]")
        self.num, self.den = num, den
        self.low, self.spec = [], []
        low = 1
        while low < 1 << 40:
            top = max(low, low * den // num)
            k = top * (den - num) // num
            t = 2 if 6 <= low and k <= 8 and low - k >= 2 else 1
            self.low.append(low)
            self.spec.append((top * den // num, k, t, self._partitions(low, top, k + t)))
            low = top + 1

    @staticmethod
    def _partitions(low: int, top: int, need: int) -> int:
        """Partitions of the domain; 0: every element is its own."""
        want = ROOM * need + 1.5 * math.sqrt(need)
        if top <= 64 or want >= 0.9 * low:
            return 0
        x = 4.0
        while (1 - math.exp(-x)) / x * low < want:
            x *= 0.97
        return math.ceil(low / x)

    def windows(self, n: int) -> list[tuple[int, int, int, int]]:
        """(window, k, t, partitions) of every window a set of size n is a member of."""
        i = bisect.bisect_right(self.low, n) - 1
        out = []
        while i >= 0 and (n <= self.spec[i][0]):
            out.append((i, *self.spec[i][1:]))
            i -= 1
        return out

    def reach(self, a, b):
        """Most elements by which linked sets of sizes a and b differ."""
        return ((a + b) * (self.den - self.num)) // (self.den + self.num)


def set_key(u: np.ndarray) -> int:
    """A 64-bit key of a set of shingle hashes: their sum (they are uniform), and the size."""
    key = (int(u.sum(dtype=np.uint64)) * 0x9E3779B97F4A7C15 + len(u)) % 2**64
    return (key ^ key >> 29) - (2**64 if key >= 2**63 else 0)


class Names:
    """Names of sets: their keys (the lowest ``bits`` of them; fewer than 64 are for tests), but
    a second key where different sets share the first."""

    def __init__(self, bits: int = 64, shared=()):
        self.mask, self.shared = (1 << bits) - 1 if bits < 64 else -1, frozenset(shared)

    def key(self, u: np.ndarray) -> int:
        return set_key(u) & self.mask

    def second(self, u: np.ndarray) -> int:
        return set_key(mix(u, 21))

    def __call__(self, u: np.ndarray) -> int:
        key = self.key(u)
        return self.second(u) if key in self.shared else key


def parity(u: np.ndarray) -> bytes:
    """Parities of the set's counts in about 2 buckets an element (a power of two)."""
    bits = max(64, 1 << math.ceil(math.log2(2 * len(u)))) if len(u) else 64
    odd = np.bincount((u & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def signatures(u: np.ndarray, bands: Bands, hot: np.ndarray | None = None) -> np.ndarray:
    """Signature hashes (uint64) of the sorted distinct shingle hashes ``u``."""
    common = None if hot is None else hot[(u & np.uint64(HOT_BITS - 1)).astype(np.int64)]
    out = []
    for window, k, t, n1 in bands.windows(len(u)):
        if n1:
            part = ((u >> np.uint64(32)) * np.uint64(n1)) >> np.uint64(32)
            start = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            content = np.add.reduceat(u, start)
            last = None if common is None else np.logical_and.reduceat(common, start)
            out.append(_subsets(content, last, k, t, window))
        if not n1 or len(start) < k + t:
            out.append(_subsets(u, common, k, 1 if n1 else t, window + 1_000))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _subsets(content: np.ndarray, last: np.ndarray | None, k: int, t: int, tag: int) -> np.ndarray:
    """Hashes of the t-subsets of the first k+t contents in the global order."""
    first = k + t
    content = mix(content, tag)
    if len(content) > first:
        order = content >> np.uint64(1)
        if last is not None:
            order |= last.astype(np.uint64) << np.uint64(63)
        content = content[np.argpartition(order, first - 1)[:first]]
    if t == 1 or len(content) < t:
        return content * np.uint64(0xD6E8FEB86659FD93)  # the first in order are small numbers: spread them
    pick = np.array(list(itertools.combinations(np.sort(content).tolist(), t)), np.uint64)
    out = pick[:, 0].copy()
    for j in range(1, t):
        out = mix(out, 10) + pick[:, j]
    return mix(out, 11)


def _profile(names: Names):
    """Per row: the row's columns, set size, both keys of the set and parity bitmap."""
    def run(batches):
        for batch in batches:
            n, key, second = (np.zeros(len(batch), np.int64) for _ in range(3))
            par = [None] * len(batch)
            for i, u in shingle_sets(batch.column(0)):
                n[i] = len(u)
                if len(u):
                    key[i], second[i] = names.key(u), names.second(u)
                    par[i] = parity(u)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(n), pa.array(key), pa.array(second), pa.array(par, pa.binary())],
                ["id", "tkey", "row", "n", "node", "second", "parity"])
    return run


def _frequent(docs: DataFrame) -> np.ndarray | None:
    """Bitmap of the shingles that several texts of a bounded sample share."""
    total = docs.count()
    share = min(1.0, HOT_SAMPLE / max(total, 1))
    near = F.pmod(F.xxhash64(F.lit(17), "tkey"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))

    def each(batches):
        for batch in batches:
            for _, u in shingle_sets(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64))], ["s"])

    sample = docs.where(near).dropDuplicates(["tkey"]).select("text")
    rows = (sample.mapInArrow(trimmed(each), "s long").groupBy("s").count().where(F.col("count") >= HOT_LEAST)
            .orderBy(F.desc("count"), "s").limit(HOT_LIMIT).select("s").toPandas())
    if rows.empty:
        return None
    bits = np.zeros(HOT_BITS, bool)
    bits[rows["s"].to_numpy() & (HOT_BITS - 1)] = True
    return bits


def _pack(bands: Bands, hot, buckets: int, names: Names):
    """Texts -> rows (bucket, signatures, set positions, sets), many sets to a row."""
    def flush(sigs, owners, nodes):
        sig, own, node = np.concatenate(sigs), np.concatenate(owners), np.array(nodes, np.int64)
        _, own_first = np.unique(node, return_index=True)
        keep = np.zeros(len(node), bool)
        keep[own_first] = True  # equal sets of this pack count once
        use = keep[own]
        sig, own = sig[use], own[use]
        order = np.argsort(sig)
        sig, own = sig[order], own[order]
        bucket = ((sig >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        ids, cols = bucket[cut], ([], [], [])
        for lo, hi in zip(cut, [*cut[1:], len(sig)]):
            have, at = np.unique(own[lo:hi], return_inverse=True)
            cols[0].append((sig[lo:hi] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes())
            cols[1].append(at.astype(np.uint16 if len(have) <= 65_536 else np.uint32).tobytes())
            cols[2].append(node[have].tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids.astype(np.int32)), *(pa.array(c, pa.binary()) for c in cols)],
            ["bucket", "sigs", "owners", "nodes"])

    def run(batches):
        sigs, owners, nodes, size = [], [], [], 0
        for batch in batches:
            for _, u in shingle_sets(batch.column(0)):
                if len(u) == 0:
                    continue
                s = signatures(u, bands, hot.value if hot else None)
                sigs.append(s)
                owners.append(np.full(len(s), len(nodes), np.int64))
                nodes.append(names(u))
                size += len(s)
                if size >= FLUSH:
                    yield flush(sigs, owners, nodes)
                    sigs, owners, nodes, size = [], [], [], 0
        if nodes:
            yield flush(sigs, owners, nodes)
    return run


def _stars(batches):
    """Buckets -> (gid, a, b): b shares a signature with a, the smallest set that has it.
    gid names the group of sets if there are more than two, else it is null."""
    held: dict[int, list] = {}
    for batch in batches:
        for bucket, s, o, nodes in zip(*(c.to_pylist() for c in batch.columns)):
            node = np.frombuffer(nodes, np.int64)
            sig = np.frombuffer(s, np.uint32)
            at = np.frombuffer(o, np.uint16 if len(o) == 2 * len(sig) else np.uint32)
            held.setdefault(bucket, []).append((sig, node[at]))
    for bucket in list(held):
        packs = held.pop(bucket)
        sig, node = np.concatenate([p[0] for p in packs]), np.concatenate([p[1] for p in packs])
        order = np.argsort(sig, kind="stable")
        sig, node = sig[order], node[order]
        same = sig[1:] == sig[:-1]
        shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        sig, node = sig[shared], node[shared]
        if len(sig) == 0:
            continue
        order = np.lexsort((node, sig))
        sig, node = sig[order], node[order]
        new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])])
        sig, node = sig[new], node[new]
        start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        size = np.diff(np.concatenate([start, [len(sig)]]))
        group = np.repeat(np.arange(len(start)), size)
        name = mix(np.add.reduceat(mix(node.view(np.uint64), 11), start), 12).view(np.int64)
        once = np.zeros(len(start), bool)
        once[np.unique(name, return_index=True)[1]] = True  # a group of sets counts once
        member = np.ones(len(sig), bool)
        member[start] = False
        member &= (once & (size > 1))[group]
        group = group[member]
        yield pa.RecordBatch.from_arrays(
            [pa.array(name[group], mask=size[group] == 2), pa.array(node[start][group]), pa.array(node[member])],
            ["gid", "a", "b"])


def _sets(names: Names):
    def run(batches):
        for batch in batches:
            seen: dict[int, bytes] = {}
            for _, u in shingle_sets(batch.column(0)):
                if len(u) and (k := names(u)) not in seen:
                    seen[k] = u.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.binary())], ["node", "set"])
    return run


def _apart(par: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Parity distances of the pairs (par[a], par[b]), by pairs of widths."""
    width = np.array([len(p) for p in par])
    out = np.zeros(len(a), np.int64)
    rows, stacked = np.zeros(len(par), np.int64), {}
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        rows[own] = np.arange(len(own))
        stacked[w] = np.frombuffer(b"".join(par[i] for i in own), np.uint64).reshape(len(own), -1)
    both = width[a] * (1 << 40) + width[b]
    for key in np.unique(both).tolist():
        at = np.flatnonzero(both == key)
        for lo in range(0, len(at), 100_000):
            part = at[lo:lo + 100_000]
            x, y = stacked[key >> 40][rows[a[part]]], stacked[key & ((1 << 40) - 1)][rows[b[part]]]
            while x.shape[1] > y.shape[1]:
                x = x[:, :x.shape[1] // 2] ^ x[:, x.shape[1] // 2:]
            while y.shape[1] > x.shape[1]:
                y = y[:, :y.shape[1] // 2] ^ y[:, y.shape[1] // 2:]
            out[part] = np.bitwise_count(x ^ y).sum(axis=1)
    return out


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n entries over the links (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _spanning(node: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """(a, b): every linked node and the first of its component; a, b index ``node``."""
    name, at = np.unique(node, return_inverse=True)
    root = roots(len(name), at[a], at[b])
    own = np.flatnonzero(root != np.arange(len(name)))
    return pa.RecordBatch.from_arrays([pa.array(name[root[own]]), pa.array(name[own])], ["a", "b"])


def _folded(par: list[bytes]) -> np.ndarray:
    """Bitmaps of one width (the least), a row each."""
    width = min(map(len, par))
    rows = np.empty((len(par), width), np.uint8)
    for i, p in enumerate(par):
        x = np.frombuffer(p, np.uint8)
        while len(x) > width:
            x = x[:len(x) // 2] ^ x[len(x) // 2:]
        rows[i] = x
    return rows.view(np.uint64)


def _close(bands: Bands, n: np.ndarray, par: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the pairs that sizes and bitmaps allow among one group: from each
    member reached, what is not reached yet."""
    bits, a, b = _folded(par), [], []
    rest, queue = np.arange(len(n)), []
    while len(rest):
        if not queue:
            queue, rest = [int(rest[0])], rest[1:]
        i = queue.pop()
        if not len(rest):
            break
        near = bands.num * np.maximum(n[rest], n[i]) <= bands.den * np.minimum(n[rest], n[i])
        near[near] = np.bitwise_count(bits[rest[near]] ^ bits[i]).sum(axis=1) <= bands.reach(n[rest[near]], n[i])
        found = rest[near]
        a.append(np.full(len(found), i))
        b.append(found)
        queue += found.tolist()
        rest = rest[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, int), np.empty(0, int))


def _clusters(bands: Bands):
    """Blocks of signatures' members -> spanning edges of the pairs that sizes and bitmaps
    allow, over all blocks of a partition."""
    def run(batches):
        got = [b for b in batches if len(b)]
        if not got:
            return
        table = pa.Table.from_batches(got)
        gid, i, j, node, n = (table.column(c).to_numpy() for c in ("gid", "i", "j", "node", "n"))
        order = np.lexsort((node, j, i, gid))
        gid, i, j, node, n = (x[order] for x in (gid, i, j, node, n))
        par = table.column("parity").take(pa.array(order)).to_pylist()
        new = np.flatnonzero(np.concatenate([[True], (gid[1:] != gid[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
        size = np.diff(np.concatenate([new, [len(gid)]]))
        left, right = [], []
        for lo, m in zip(new[size > SMALL].tolist(), size[size > SMALL].tolist()):
            a, b = _close(bands, n[lo:lo + m], par[lo:lo + m])
            left.append(a + lo)
            right.append(b + lo)
        after = np.repeat(new + size, size) - np.arange(len(gid)) - 1
        after[np.repeat(size > SMALL, size)] = 0
        cut = np.searchsorted(np.cumsum(after), np.arange(0, int(after.sum()) + PAIRS, PAIRS))
        cut = np.unique(np.concatenate([[0], cut, [len(gid)]]))
        for lo, hi in zip(cut, cut[1:]):
            count = after[lo:hi]
            x = np.repeat(np.arange(lo, hi), count)
            y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count)
            ok = bands.num * np.maximum(n[x], n[y]) <= bands.den * np.minimum(n[x], n[y])
            x, y = x[ok], y[ok]
            pair = np.lexsort((node[y], node[x]))  # the members of a group are in order of their names
            once = np.ones(len(pair), bool)
            once[1:] = (node[x[pair]][1:] != node[x[pair]][:-1]) | (node[y[pair]][1:] != node[y[pair]][:-1])
            x, y = x[pair[once]], y[pair[once]]
            near = _apart(par, x, y) <= bands.reach(n[x], n[y])
            left.append(x[near])
            right.append(y[near])
        yield _spanning(node, np.concatenate(left), np.concatenate(right))
    return run


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs of sorted distinct arrays."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    element = np.concatenate(sets)
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], element[1:] != element[:-1]]))
    held = np.diff(np.concatenate([start, [len(element)]]))
    both = np.zeros((m, m), np.float32 if max(map(len, sets)) < 1 << 24 else np.float64)
    for df in range(2, DENSE + 1):  # rare shingles: their pairs, one multiplicity at a time
        at = start[held == df]
        if len(at):
            rows = owner[at[:, None] + np.arange(df)]
            for p in range(df):
                for q in range(p + 1, df):
                    np.add.at(both, (rows[:, p], rows[:, q]), 1)
    dense = np.flatnonzero(held > DENSE)
    for lo in range(0, len(dense), 2_048):
        some = dense[lo:lo + 2_048]
        hit = np.zeros((m, len(some)), both.dtype)
        for c, k in enumerate(some):
            hit[owner[start[k]:start[k] + held[k]], c] = 1
        part = hit @ hit.T
        both += np.triu(part, 1)  # owners of a shingle are in order, so all counts are above the diagonal
    return both


def _linked(bands: Bands):
    """Blocks of clusters' full sets -> spanning edges of the exact links."""
    def run(batches):
        held: dict[tuple, list] = {}
        for batch in batches:
            for key in zip(*(batch.column(c).to_pylist() for c in ("cluster", "i", "j", "node", "set"))):
                held.setdefault(key[:3], []).append(key[3:])
        nodes, left, right, at = [], [], [], 0
        for key in list(held):
            rows = held.pop(key)
            sets = [np.frombuffer(s, np.uint64) for _, s in rows]
            n = np.array([len(s) for s in sets])
            both = _common(sets)
            a, b = np.nonzero((bands.den + bands.num) * both.astype(np.float64) >= bands.num * (n[:, None] + n[None, :]))
            left.append(a + at)
            right.append(b + at)
            nodes += [k for k, _ in rows]
            at += len(rows)
        if nodes:
            yield _spanning(np.array(nodes, np.int64), np.concatenate(left), np.concatenate(right))
    return run


def _in_blocks(rows: DataFrame, of: Column) -> DataFrame:
    """Each row once for every pair of blocks (i <= j) of its key that its own block is in."""
    own = F.pmod(F.xxhash64("node"), F.col("_of")).cast("int")
    rows = rows.withColumn("_of", of.cast("int")).withColumn("_own", own)
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_of") - 1)))
    return (rows.withColumn("i", F.least("_own", "_other")).withColumn("j", F.greatest("_own", "_other"))
            .drop("_of", "_own", "_other"))


def _exact_links(links: DataFrame, classes: DataFrame, docs: DataFrame, bands: Bands, parts: int, names: Names) -> DataFrame:
    """Spanning edges (a, b) of the links between the sets that share signatures."""
    links = links.withColumn("gid", F.coalesce("gid", F.xxhash64("a", "b")))
    groups = links.groupBy("gid").agg((F.count("*") + 1).alias("size"), F.min("a").alias("node"))
    members = (links.select("gid", F.col("b").alias("node")).join(groups.select("gid", "size"), "gid")
               .unionByName(groups.select("gid", "node", "size"))
               .join(classes.select("node", "n", "parity"), "node"))
    blocks = _in_blocks(members, F.ceil(F.col("size") / BLOCK)).select("gid", "i", "j", "node", "n", "parity")
    edges = blocks.repartition(parts, "gid", "i", "j").mapInArrow(trimmed(_clusters(bands)), "a long, b long").distinct()
    clusters = connected_components(edges).withColumnRenamed("root", "cluster")

    wanted = bitmap(classes.join(clusters, "node"), "tkey")
    texts = maybe(docs, wanted, F.col("tkey"), "read").where("read").select("text")
    sets = texts.mapInArrow(trimmed(_sets(names)), "node long, set binary").dropDuplicates(["node"]).join(clusters, "node")
    sizes = (classes.join(clusters, "node").groupBy("cluster")
             .agg(F.greatest(F.ceil(F.count("*") / SET_ROWS), F.ceil(8 * F.sum("n") / SET_BYTES)).alias("of")))
    blocks = _in_blocks(sets.join(sizes, "cluster"), F.col("of")).select("cluster", "i", "j", "node", "set")
    return blocks.repartition(parts, "cluster", "i", "j").mapInArrow(trimmed(_linked(bands)), "a long, b long")


def _classes(rows: DataFrame) -> DataFrame:
    """The different sets, by name."""
    return materialize(rows.where("n > 0").groupBy("node").agg(
        F.min("id").alias("id"), F.min("tkey").alias("tkey"), F.min("n").alias("n"), F.min("parity").alias("parity"),
        F.min("second").alias("low"), F.max("second").alias("high")), "jaccard-sets")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       num: int = 75, den: int = 100, key_bits: int = 64) -> DataFrame:
    """(id, n_shingles, component_id, component, row) for every row of ``docs``; component
    is null if nothing can link, row is the 128-bit key of (id, text)."""
    bands = Bands(num, den)
    docs = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"))
    docs = docs.withColumn("tkey", F.xxhash64("text")).withColumn("row", wide_key(F.col("id"), F.col("text")))
    id_type = docs.schema["id"].dataType.simpleString()
    row_type = docs.schema["row"].dataType.simpleString()
    rows = materialize(docs.select("text", "id", "tkey", "row").mapInArrow(
        _profile(Names(key_bits)),
        f"id {id_type}, tkey long, row {row_type}, n long, node long, second long, parity binary"), "jaccard-rows")
    classes = _classes(rows)
    shared = shared_keys(classes, "node", "low", "high")
    if shared:
        rows = renamed(rows, "node", "second", shared)
        classes = _classes(rows)
    names = Names(key_bits, shared)

    parts = parts_for(docs)
    hot = _frequent(docs)
    hot = None if hot is None else docs.sparkSession.sparkContext.broadcast(hot)
    packed = docs.select("text").mapInArrow(
        _pack(bands, hot, 4 * parts, names), "bucket int, sigs binary, owners binary, nodes binary")
    links = materialize(packed.repartition(parts, "bucket").mapInArrow(trimmed(_stars), "gid long, a long, b long")
                        .distinct(), "jaccard-stars")

    labels = connected_components(_exact_links(links, classes, docs, bands, parts, names))
    own = classes.select("node", "id").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = own.groupBy("root").agg(F.min("id").alias("component_id"))
    named = materialize(own.join(smallest, "root").select(F.col("node").alias("c"), "component_id", "root"),
                        "jaccard-components")
    return (rows.join(named, (F.col("n") > 0) & (F.col("node") == F.col("c")), "left")
            .select("id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
                    F.col("root").alias("component"), "row"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 75, den: int = 100) -> DataFrame:
    """The documents with their own columns, one of each component: the smallest id (nulls
    last), one row of it.  Rows without words all stay.  A bitmap of the rows that may
    go lets the others stay where they are; only the former are shuffled."""
    found = materialize(jaccard_components(docs, id_col, text_col, num, den).where("component is not null")
                        .select("component", "id", "row"), "jaccard-rows-found")
    first = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"))
    first = first.select(F.col("first.row").alias("row"))
    often = found.groupBy("row").count().where("count > 1").select("row")
    go = found.select("row").distinct().join(first, "row", "left_anti").union(often)
    k, flag = fresh(docs, "_row"), fresh(docs, "_maybe")
    text = F.col(text_col).cast("string")
    marked = docs.withColumn(k, wide_key(F.col(id_col), text))
    marked = maybe(marked, bitmap(go.select("row.h1"), "h1"), F.col(k)["h1"], flag)
    wordless = ~F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    stay = marked.where(wordless | ~F.col(flag))
    rest = (marked.where(~wordless & F.col(flag)).join(first.select(F.col("row").alias(k)), k)
            .dropDuplicates([k]).select(*marked.columns))
    return stay.unionByName(rest).drop(k, flag)


def op8_jaccard_join(spark, sf_dir):
    out = jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
