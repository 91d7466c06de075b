import hashlib
import zlib

import duckdb
import numpy as np
import pytest

from sparkfeat.llm import merkle

from .data import edge_docs, frame

H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def level_up(nodes):
    return [H("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]


def root_of(nodes):
    while len(nodes) > 1:
        nodes = level_up(nodes)
    return nodes[0]


def walk(nodes, i, digest):
    """Siblings upwards, and the root that ``digest`` gives in place ``i``."""
    proof = ""
    while len(nodes) > 1:
        run = nodes[i // 8 * 8:i // 8 * 8 + 8]
        proof += "".join(x for j, x in enumerate(run) if j != i % 8)
        run[i % 8] = digest
        digest, nodes, i = H("".join(run)), level_up(nodes), i // 8
    return proof, digest


def leaf(row, lower=False):
    i, source, lang, n, text = row
    if lower and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def by_hand(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded root) of (id, source, lang, n_chars, text) rows."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    subroots = [root_of([x[2] for x in sorted(trees[g], key=lambda x: x[:3])]) for g in langs]
    root, out = root_of(subroots), []
    for at, g in enumerate(langs):
        kept = sorted(trees[g], key=lambda x: x[:3])
        for i, (_, _, digest, row) in enumerate(kept):
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            proof, up = walk([x[2] for x in kept], i, leaf(row, bad))
            top, folded = walk(list(subroots), at, up)
            out.append((row[0], digest, subroots[at], root, proof + top, folded))
    return sorted(out, key=repr)


def proofs(spark, docs, rows):
    bad = merkle.F.coalesce(merkle.F.crc32(merkle.F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.F.lit(False))
    claims = {"text": merkle.F.when(bad, merkle.F.translate("text", merkle.UPPER, merkle.LOWER)).otherwise(merkle.F.col("text"))}
    got, root = merkle.audit(docs, claims=claims)
    return sorted(((r["id"], r["leaf"], r["subroot"], root, "".join(r["proof"]), r["folded_root"]) for r in got.collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_against_brute_force(spark, monkeypatch, levels):
    """One tier and many: blocks of 8, 64 and 4,096 leaves give the same proofs."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    docs = edge_docs() + [d[:2] + (f"l{i % 11}",) + d[3:] for i, d in enumerate(edge_docs())]
    rows = [(d[0], d[3], d[2], d[4], d[1]) for d in docs]
    assert proofs(spark, frame(spark, docs), rows) == by_hand(rows)


def test_many_leaves_in_one_tree(spark):
    docs = spark.range(9_000).selectExpr("id AS doc_id", "concat('Text ', id) AS text", "'en' AS lang", "'s' AS source", "id % 7 AS n_chars")
    rows = [(i, "s", "en", i % 7, f"Text {i}") for i in range(9_000)]
    assert proofs(spark, docs, rows) == by_hand(rows)


def test_lone_leaf_and_empty_table(spark):
    rows = [(5, "s", None, 1, "A")]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    docs = spark.createDataFrame(rows, schema)
    assert proofs(spark, docs, rows) == by_hand(rows)
    got, root = merkle.audit(spark.createDataFrame([], schema))
    assert root is None and got.collect() == []


def test_layout():
    """Every node has a place of its own; a bottom part lies in one piece, its root first."""
    for levels in range(1, 6):
        at = [merkle.address(d, np.arange(8 ** d), levels) for d in range(levels)]
        assert sorted(np.concatenate(at)) == list(range(merkle.nodes_in(levels)))
    top, below = 2, 3
    for r in range(8 ** top):
        part = np.concatenate([merkle.address(top + d, np.arange(r * 8 ** d, (r + 1) * 8 ** d), 5) for d in range(below)])
        assert part[0] == part.min() and part.max() - part.min() == merkle.nodes_in(below) - 1


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = merkle.op11_merkle_manifest(spark, sf)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({merkle.ORACLE})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
