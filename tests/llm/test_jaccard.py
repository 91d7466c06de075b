import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkfeat.llm import jaccard, textkit

from .data import DOCS, doc, edge_docs, frame, prose, shingles, words


def components(rows):
    """Brute force: smallest id reachable, by row."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    best = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            best[find(i)] = min(best.get(find(i), r[0]), r[0])
    return [(r[0], len(s), best.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))]


def order(rows):
    return sorted(rows, key=repr)


def test_against_brute_force(spark):
    rows = edge_docs()
    got = jaccard.jaccard_components(frame(spark, rows)).select("id", "n_shingles", "component_id").collect()
    assert order(tuple(r) for r in got) == order(components(rows))


def test_partitioning_does_not_change_the_result(spark):
    rows = edge_docs()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        a = jaccard.jaccard_components(frame(spark, rows).repartition(7)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert order((r["id"], r["n_shingles"], r["component_id"]) for r in a) == order(components(rows))


def test_one_of_each(spark):
    rows = edge_docs()
    out = jaccard.one_of_each(frame(spark, rows))
    assert out.columns == DOCS.names
    got = [r["doc_id"] for r in out.collect()]
    wordless = [r[0] for r in rows if not shingles(r[1])]
    roots = {c for i, n, c in components(rows) if n}
    assert order(got) == order(wordless + list(roots))


def test_empty_table(spark):
    empty = frame(spark, [])
    assert jaccard.jaccard_components(empty).count() == 0
    assert jaccard.one_of_each(empty).count() == 0


def test_only_empty_texts(spark):
    out = jaccard.jaccard_components(frame(spark, [doc(1, ""), doc(2, None), doc(2, None)])).collect()
    assert order((r["id"], r["n_shingles"], r["component_id"]) for r in out) == [(1, 0, 1), (2, 0, 2), (2, 0, 2)]


@pytest.mark.parametrize("hot", [False, True])
@settings(max_examples=150, deadline=None)
@given(st.integers(1, 900), st.integers(0, 2**32), st.floats(0.0, 1.0))
def test_linked_sets_share_a_signature(hot, n, seed, part):
    """Whatever the size and the common shingles: every pair that links meets."""
    r = np.random.default_rng(seed)
    bands = jaccard.Bands()
    a = np.unique(r.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    drop = int(part * len(a) * 0.25)
    most = (len(a) - drop) * 100 // 75 - len(a) if drop < len(a) else 0
    add = r.integers(0, 2**63, int(r.integers(0, max(1, most + 1))), dtype=np.uint64) * np.uint64(2)
    b = np.unique(np.concatenate([a[drop:], add]))
    both = len(np.intersect1d(a, b))
    if 100 * both < 75 * (len(a) + len(b) - both):
        return
    bits = r.random(jaccard.HOT_BITS) < 0.7 if hot else None
    x, y = jaccard.signatures(a, bands, bits), jaccard.signatures(b, bands, bits)
    assert len(np.intersect1d(x, y)) > 0
    near = jaccard._apart([jaccard.parity(a), jaccard.parity(b)], np.array([0]), np.array([1]))[0]
    assert near <= bands.reach(len(a), len(b))


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "SET_ROWS", 16)
    monkeypatch.setattr(jaccard, "SMALL", 4)
    monkeypatch.setattr(jaccard, "DENSE", 3)
    rows = edge_docs()
    got = jaccard.jaccard_components(frame(spark, rows)).select("id", "n_shingles", "component_id").collect()
    assert order(tuple(r) for r in got) == order(components(rows))


def test_word_hashes_follow_the_words():
    texts = ["A b\tC", None, "", "ab  É x\n", "z" * 3_000_000, prose(1, 400_000), "a b c"]
    got = {}
    for first, h, off in textkit.words(pa.array(texts)):
        for i in range(len(off) - 1):
            got[first + i] = h[off[i]:off[i + 1]].tolist()
    names = {}
    for i, t in enumerate(texts):
        w = words(t)
        assert len(got[i]) == len(w)
        for name, h in zip(w, got[i]):
            assert names.setdefault(name, h) == h
    assert len(set(names.values())) == len(names)
    assert got[0] == got[6]


@pytest.mark.parametrize("bits", [2, 9])
def test_sets_that_share_a_key(spark, bits):
    """Keys of a few bits, which many different sets share, change nothing."""
    docs = frame(spark, edge_docs())
    plain, got = (sorted(map(repr, (tuple(r) for r in jaccard.jaccard_components(docs, key_bits=b).select(
        "id", "n_shingles", "component_id").collect()))) for b in (64, bits))
    assert got == plain and len(plain) == len(edge_docs())


def test_names_of_sets():
    u, v = np.arange(1, 40, dtype=np.uint64), np.arange(2, 41, dtype=np.uint64)
    names = jaccard.Names()
    assert names(u) == jaccard.set_key(u) != names(v)
    shared = jaccard.Names(0, [0])
    assert shared.key(u) == shared.key(v) == 0 and shared(u) != shared(v)
