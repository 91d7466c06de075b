"""Merkle dataset manifest in van Emde Boas layout (operator 11).

Every row is a leaf, every value of a group column a tree of arity 8 over its leaves in
id order, and the trees' roots are the leaves of one more tree.  A tree is cut into
aligned subtrees of ``LEVELS`` levels of hashing (8 ** 4 leaves).  Such a block is one
row of the manifest: its digests (32 bytes each) lie in one binary value in van Emde
Boas order, i.e. split at half height, the top part first, then every bottom part, each
laid out alike.  A node's place follows from depth and index alone (``address``), so
neither building a block nor reading the siblings of a leaf needs pointers or a search.
The roots of a tier's blocks are the leaves of the next tier's; 5e10 rows take three
tiers.

In Spark: leaf digests are built-in functions of the scan, so no text is shuffled; the
position of a leaf in its tree comes from the range-partitioned index, so a tree with a
third of all rows is ranked by many tasks; a block is one group of at most 4,096
digests.  Proofs go top-down: the paths of a tier's block roots are joined with the
blocks below, and at the bottom rows meet their block in a cogroup of at most 4,096
rows.  Every tier is a written table, so a lost executor costs only its tasks.

Defined results: a null value enters a leaf as ``-``, so it differs from an empty one;
null ids come first in their tree, rows with equal ids go by leaf digest, and repeated
rows are leaves of their own (interchangeable); a null group is a tree of its own, the
first; texts are hashed whole; further columns play no part unless they are named in
``columns``; an empty table gives an empty manifest (no root) and no proofs.
"""
from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.order import global_index, null_safe_join
from .common import materialize

ARITY = 8
LEVELS = 4  # levels of hashing in a block
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def nodes_in(levels: int) -> int:
    """Nodes of a full subtree with so many levels of nodes."""
    return (ARITY ** levels - 1) // (ARITY - 1)


def address(depth: int, index, levels: int):
    """Van Emde Boas place of the node ``index`` (a number or array) at ``depth`` (root: 0)
    of a subtree with ``levels`` levels of nodes."""
    if levels == 1:
        return index * 0
    top = levels // 2
    if depth < top:
        return address(depth, index, top)
    span = ARITY ** (depth - top)  # nodes at this depth below one root of a bottom part
    return nodes_in(top) + index // span * nodes_in(levels - top) + address(depth - top, index % span, levels - top)


@lru_cache(maxsize=None)
def _places(depth: int, levels: int) -> np.ndarray:
    return address(depth, np.arange(ARITY ** depth), levels)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height_of(n: int) -> int:
    """Levels of hashing from ``n`` nodes to one; ``LEVELS`` at most (the block's)."""
    height = 0
    while height < LEVELS and ARITY ** height < n:
        height += 1
    return height


def build_block(leaves: list[str], height: int) -> tuple[bytes, str]:
    """The block over hex digests, in layout order, and its root."""
    nodes = np.zeros((nodes_in(height + 1), 32), np.uint8)
    level = leaves
    for depth in range(height, -1, -1):
        nodes[_places(depth, height + 1)[:len(level)]] = np.frombuffer(bytes.fromhex("".join(level)), np.uint8).reshape(-1, 32)
        if depth:
            level = [_digest("".join(level[i:i + ARITY])) for i in range(0, len(level), ARITY)]
    return nodes.tobytes(), level[0]


class Block:
    """Reads siblings out of a block's layout."""

    def __init__(self, nodes: bytes, height: int, leaves: int):
        store = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
        self.height, self.leaves, self.rows = height, leaves, []
        n = leaves
        for depth in range(height, 0, -1):
            self.rows.append((store[_places(depth, height + 1)[:n]].tobytes().hex(), n))
            n = -(-n // ARITY)

    def path(self, i: int) -> list[str]:
        """Left and right siblings of leaf ``i`` by level, upwards: [left, right, left, ...]."""
        out = []
        for digests, n in self.rows:
            first = i // ARITY * ARITY
            out.append(digests[64 * first:64 * i])
            out.append(digests[64 * (i + 1):64 * min(first + ARITY, n)])
            i //= ARITY
        return out


def fold(digest: str, path: list[str]) -> str:
    """The root that a leaf digest and its siblings give."""
    for left, right in zip(path[::2], path[1::2]):
        digest = _digest(left + digest + right)
    return digest


@dataclass
class Manifest:
    trees: DataFrame  # tree, group, n, subroot, path (from the subroot to the root)
    tiers: list[DataFrame]  # block, tree, n, height, leaves, nodes, root
    root: str | None


def leaf_digest(columns: list[Column]) -> Column:
    """sha256 of the values: ``-`` for a null, else byte count, colon, value."""
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
             for c in (c.cast("string") for c in columns)]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


_BLOCK = "tree long, block long, n long, height int, leaves int, nodes binary, root string"


def _build(table: pa.Table) -> pa.Table:
    table = table.sort_by("pos")
    leaves, n = table["digest"].to_pylist(), table["n"][0].as_py()
    height = height_of(n)
    nodes, root = build_block(leaves, height)
    return pa.table({"tree": table["tree"][:1].cast(pa.int64()), "block": table["block"][:1].cast(pa.int64()),
                     "n": pa.array([n], pa.int64()), "height": pa.array([height], pa.int32()),
                     "leaves": pa.array([len(leaves)], pa.int32()), "nodes": pa.array([nodes], pa.binary()),
                     "root": pa.array([root], pa.string())})


def _tiers(leaves: DataFrame) -> list[DataFrame]:
    """Blocks of every tier over (tree, pos, digest, n), n being the nodes of the tree."""
    size, tiers = ARITY ** LEVELS, []
    while True:
        rows = leaves.select("tree", "pos", "digest", "n", F.floor(F.col("pos") / size).alias("block"))
        blocks = materialize(rows.groupBy("tree", "block").applyInArrow(_build, _BLOCK), f"merkle-tier-{len(tiers)}")
        tiers.append(blocks)
        above = blocks.where(F.col("n") > size)
        if above.isEmpty():
            return tiers
        leaves = above.select("tree", F.col("block").alias("pos"), F.col("root").alias("digest"),
                              F.ceil(F.col("n") / size).alias("n"))


def _expand(batches):
    """(tree, block) paths of the tier below, from blocks with the path of their root."""
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row["nodes"], row["height"], row["leaves"])
            first = row["block"] * ARITY ** LEVELS
            paths = [block.path(i) + row["path"] for i in range(block.leaves)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["tree"]] * block.leaves, pa.int64()), pa.array(range(first, first + block.leaves), pa.int64()),
                 pa.array(paths, pa.list_(pa.string()))], ["tree", "block", "path"])


def _paths(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(tree, block, path) of the lowest tier; ``tops`` (tree, path): from each tree's root on."""
    paths = None
    for tier in reversed(tiers):
        at = tier.where(F.col("n") <= ARITY ** LEVELS).select("tree", "block").join(tops, "tree")
        paths = at if paths is None else at.unionByName(paths)
        if tier is not tiers[0]:
            paths = materialize(tier.join(paths, ["tree", "block"])
                                .select("tree", "block", "height", "leaves", "nodes", "path")
                                .mapInArrow(_expand, "tree long, block long, path array<string>"), "merkle-paths")
    return paths


def _tree_roots(tiers: list[DataFrame]) -> DataFrame:
    out = None
    for tier in tiers:
        tops = tier.where(F.col("n") <= ARITY ** LEVELS).select("tree", F.col("root").alias("subroot"))
        out = tops if out is None else out.unionByName(tops)
    return out


def build_manifest(leaves: DataFrame) -> tuple[DataFrame, Manifest]:
    """``leaves`` (id, grp, leaf, ...) with their tree and position, and the manifest over them."""
    ranked, sizes = global_index(leaves, ["id", "leaf"], partition_by=["grp"], rn="pos")
    groups, total = global_index(sizes, ["grp"], rn="tree")
    groups = materialize(groups, "merkle-groups")
    placed = materialize(null_safe_join(ranked, groups, ["grp"]), "merkle-leaves")
    tiers = _tiers(placed.select("tree", "pos", F.col("leaf").alias("digest"), "n"))
    roots = _tree_roots(tiers).join(groups, "tree")
    n = groups.count()
    if n == 0:
        return placed, Manifest(roots.withColumn("path", F.lit(None).cast("array<string>")), tiers, None)
    over = _tiers(roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"),
                               F.col("subroot").alias("digest"), F.lit(n).cast("long").alias("n")))
    nothing = over[-1].limit(1).select("tree", F.array().cast("array<string>").alias("path"))
    way = over[0].join(_paths(over, nothing), ["tree", "block"]).select("tree", "block", "height", "leaves", "nodes", "path")
    way = way.mapInArrow(_expand, "tree long, block long, path array<string>").select(F.col("block").alias("tree"), "path")
    return placed, Manifest(materialize(roots.join(way, "tree"), "merkle-trees"), tiers, over[-1].first()["root"])


def _prove(key, rows: pa.Table, blocks: pa.Table) -> pa.Table:
    row = blocks.to_pylist()[0]
    block = Block(row["nodes"], row["height"], row["leaves"])
    first, paths, folded = row["block"] * ARITY ** LEVELS, [], []
    for pos, digest in zip(rows["pos"].to_pylist(), rows["claim"].to_pylist()):
        path = block.path(pos - first) + row["path"]
        paths.append(path)
        folded.append(fold(digest, path))
    out = rows.drop_columns(["tree", "block", "pos", "claim"])
    out = out.append_column("subroot", pa.array([row["subroot"]] * len(rows), pa.string()))
    out = out.append_column("proof", pa.array(paths, pa.list_(pa.string())))
    return out.append_column("folded_root", pa.array(folded, pa.string()))


def prove(placed: DataFrame, manifest: Manifest, claim: str = "leaf") -> DataFrame:
    """Siblings of every placed row (upwards, left and right by level) and the root that they
    give with the digest in column ``claim``: (id, leaf, subroot, proof, folded_root)."""
    blocks = manifest.tiers[0].join(_paths(manifest.tiers, manifest.trees.select("tree", "path")), ["tree", "block"])
    blocks = blocks.join(manifest.trees.select("tree", "subroot"), "tree")
    rows = placed.select("tree", F.floor(F.col("pos") / ARITY ** LEVELS).alias("block"), "pos", "id", "leaf",
                         F.col(claim).alias("claim"))
    schema = f"id {placed.schema['id'].dataType.simpleString()}, leaf string, subroot string, proof array<string>, folded_root string"
    return (rows.groupBy("tree", "block")
            .cogroup(blocks.select("tree", "block", "height", "leaves", "nodes", "path", "subroot").groupBy("tree", "block"))
            .applyInArrow(_prove, schema))


def audit(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
          columns=COLUMNS, claims: dict[str, Column] | None = None) -> tuple[DataFrame, str | None]:
    """Manifest over ``docs`` and a proof for every row; ``claims`` replaces columns by what a
    holder of the row presents.  Returns the proofs and the root (None: no rows)."""
    present = [(claims or {}).get(c, F.col(c)) for c in columns]
    leaves = docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"),
                         leaf_digest([F.col(c) for c in columns]).alias("leaf"), leaf_digest(present).alias("claimed"))
    placed, manifest = build_manifest(leaves)
    return prove(placed, manifest, "claimed"), manifest.root


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle_manifest(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    claims = {"text": F.when(tampered, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))}
    proofs, root = audit(docs, claims=claims)
    return proofs.select(F.col("id").alias("doc_id"), "leaf", "subroot", F.lit(root).cast("string").alias("root"),
                         F.sha2(F.array_join("proof", "").cast("binary"), 256).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.lit(root)).alias("verified"))


def crc32_sql(text: str) -> str:
    """DuckDB expression: unsigned crc32 of a short ASCII text."""
    byte = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte}), lambda c, b: {bits}), 4294967295)"


def _climb(at: str, nodes: str, levels: int) -> tuple[str, str]:
    """CTEs that hash ``nodes`` (tree, i, d) level by level and fold ``at`` (r, tree, i, d, proof)
    along; names of the last nodes and rows."""
    out = []
    for _ in range(levels):
        up, to = f"{nodes}u", f"{at}u"
        out.append(f"""{nodes}c AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {nodes})""")
        out.append(f"""{up} AS (SELECT tree, i // 8 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM {nodes}c WHERE n > 1
GROUP BY tree, i // 8 UNION ALL SELECT tree, i, d FROM {nodes}c WHERE n = 1)""")
        out.append(f"""{to} AS (SELECT a.r, any_value(a.tree) AS tree, any_value(a.i) // 8 AS i,
CASE WHEN any_value(s.n) = 1 THEN any_value(a.d) ELSE sha256(string_agg(CASE WHEN s.i = a.i THEN a.d ELSE s.d END, '' ORDER BY s.i)) END AS d,
any_value(a.proof) || coalesce(string_agg(s.d, '' ORDER BY s.i) FILTER (s.i <> a.i), '') AS proof
FROM {at} a JOIN {nodes}c s ON s.tree = a.tree AND s.i // 8 = a.i // 8 GROUP BY a.r)""")
        nodes, at = up, to
    return ",\n".join(out), nodes, at


def _oracle(levels: int = 7) -> str:
    part = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(part(c if c != "text" else text) for c in COLUMNS) + ")"
    changed = (f"CASE WHEN doc_id IS NOT NULL AND {crc32_sql('doc_id::VARCHAR')} % 3 = 0 "
               f"THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END")
    low, nodes, at = _climb("a", "t", levels)
    top, nodes2, at2 = _climb("b", "g", 3)
    return f"""WITH docs AS (SELECT *, {changed} AS claimed FROM documents),
l AS (SELECT doc_id, lang, {leaf('text')} AS leaf, {leaf('claimed')} AS claim FROM docs),
k AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST, leaf) AS r,
dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l),
t AS (SELECT tree, i, leaf AS d FROM k), a AS (SELECT r, tree, i, claim AS d, '' AS proof FROM k),
{low},
g AS (SELECT 0 AS tree, tree AS i, d FROM {nodes}),
b AS (SELECT r, 0 AS tree, tree AS i, d, proof FROM {at}),
{top}
SELECT k.doc_id, k.leaf, s.d AS subroot, o.d AS root, sha256(f.proof) AS proof_sha256, f.d AS folded_root, f.d = o.d AS verified
FROM k JOIN {nodes} s ON s.tree = k.tree JOIN {at2} f ON f.r = k.r CROSS JOIN {nodes2} o"""


ORACLE = _oracle()
