import math

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from sparkfeat.llm import components, embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, node long, unit string"


def vectors():
    r = np.random.default_rng(5)
    rows = []
    for c in range(30):
        centre = r.normal(size=24)
        for k in range(1 + c % 9):
            rows.append((len(rows), (centre + r.normal(size=24) * 0.12).astype(np.float32).tolist()))
    first = rows[0][1]
    rows += [(1000, first), (1000, first), (None, first), (1001, [2 * x for x in first]), (1002, [-x for x in first]),
             (1003, [0.0] * 24), (1004, None), (1005, []), (1006, [math.nan] + first[1:]), (1007, [math.inf] + first[1:]),
             (1008, [None] + first[1:]), (1009, first[:12]), (1010, first[:12]), (1011, [1e30 * x for x in first]), (None, None)]
    return [(i, v, 0, 7, "u") for i, v in rows]


def by_hand(rows):
    x = [None if v is None or not v or any(e is None or not math.isfinite(e) for e in v) else np.array(v, np.float32).astype(float)
         for _, v, *_ in rows]
    x = [None if v is None or not np.isfinite(v).all() or not v.any() else v / np.abs(v).max() for v in x]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if x[i] is not None and x[j] is not None and len(x[i]) == len(x[j]):
                if x[i] @ x[j] / math.sqrt((x[i] @ x[i]) * (x[j] @ x[j])) >= 0.95:
                    links[i] += 1
                    links[j] += 1
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    best = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            best[find(i)] = min(best.get(find(i), r[0]), r[0])
    return [(r[0], links[i], best.get(find(i)), r[0] == best.get(find(i))) for i, r in enumerate(rows)]


@pytest.mark.parametrize("block", [8192, 16])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = vectors()
    got = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, by_hand(rows)))


@pytest.mark.parametrize("bits", [1, 6])
def test_vectors_that_share_a_key(spark, bits):
    rows = vectors()
    got = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA), key_bits=bits).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, by_hand(rows)))


def test_recall_with_planted_copies(spark):
    """The whole table with near copies at cosines around and above the threshold."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in rows], float)
    r = np.random.default_rng(3)
    at = r.integers(0, 400, 900)
    noise = r.normal(size=(900, x.shape[1]))
    noise *= (np.linalg.norm(x[at], axis=1) / np.linalg.norm(noise, axis=1) * r.uniform(0.02, 0.34, 900))[:, None]
    x = np.concatenate([x, x[at] + noise]).astype(np.float32).astype(float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (u @ u.T >= 0.95).sum(axis=1) - 1
    got = {g["id"]: g["n_links"] for g in embeddings.near_duplicates(spark.createDataFrame(
        [(i, v.tolist(), 0, 1, "u") for i, v in enumerate(x)], SCHEMA)).collect()}
    assert all(got[i] <= want[i] for i in got)  # none below the threshold
    print("recall", sum(got.values()) / want.sum(), want.sum())
    assert sum(got.values()) >= 0.97 * want.sum() and want.sum() > 1500


def test_recall_with_a_group_of_near_copies(spark, tmp_path):
    """A third of 40,000 vectors near one another: no list may cut the group's links."""
    r = np.random.default_rng(4)
    x = r.normal(size=(40_000, 64)) / 8
    x[:13_333] = x[0] + r.normal(size=(13_333, 64)) * 0.21 / 8
    x = x[r.permutation(len(x))].astype(np.float32)
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x))}), tmp_path / "v.parquet")
    got = embeddings.near_duplicates(spark.read.parquet(str(tmp_path / "v.parquet"))).collect()
    links = np.array([n for _, n in sorted((g["id"], g["n_links"]) for g in got)])
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = np.concatenate([(u[lo:lo + 2000] @ u.T >= 0.95).sum(axis=1) - 1 for lo in range(0, len(u), 2000)])
    print("recall", links.sum() / want.sum(), want.sum())
    assert (links <= want).all() and links.sum() >= 0.97 * want.sum() and want.sum() > 10**7


def test_codes_never_lose_a_close_pair_of_a_list():
    r = np.random.default_rng(1)
    x = r.normal(size=(600, 16))
    x[300:] = x[:300] + r.normal(size=(300, 16)) * 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = embeddings.Quantiser(x, 12)
    probes, codes, missed = q.encode(x)
    radius = math.sqrt(2 - 2 * 0.95) + 1e-7
    for cell in range(12):
        member = np.flatnonzero(probes[:, 0] == cell)
        table = q.tables(x, cell)
        far = sum(table[:, s, :][:, codes[member, s]] for s in range(codes.shape[1]))
        close = x @ x[member].T >= 0.95
        assert (far[close] <= ((radius + missed[member]) ** 2 + 1e-9)[None].repeat(len(x), 0)[close]).all()


def test_nothing_to_link(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    got = embeddings.near_duplicates(spark.createDataFrame([(1, None, 0, 1, "u"), (2, [0.0], 0, 1, "u")], SCHEMA)).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_components(spark):
    r = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 400, (260, 2))]
    edges += [(i, i + 1) for i in range(1000, 1200)] + [(5000, x) for x in range(4000, 4300)] + [(7, 7), (None, 3), (3, None)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = components.connected_components(spark.createDataFrame(edges * 2, "a long, b long")).collect()
    assert {n: c for n, c in got} == {n: find(n) for n in root} and len(got) == len(root)
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = sorted(con.execute(embeddings.ORACLE).fetchall())
    assert sorted(map(tuple, embeddings.op1_pq_neardup(spark, sf).collect())) == want
