"""Exact kNN over the metric index: equal neighbours on every shape, and what it skips."""
import numpy as np
import pytest

from sparkfeat.operators import knn as K
from sparkfeat.operators.metric_index import cell_count, pivot_distances

SCHEMA = "id long, features array<double>, label int, fold int, extra string"


def by_hand(T, Q, k, tg=None, qg=None):
    out = []
    for i, q in enumerate(Q):
        d = np.sqrt(((T - q) ** 2).sum(1))
        if tg is not None:
            d[tg == qg[i]] = np.inf
        order = np.lexsort((np.arange(len(T)), d))[:k]
        out.append([int(j) for j in order if np.isfinite(d[j])])
    return out


def shapes(kind, n, dims, r):
    if kind == "clusters":
        return r.normal(size=(20, dims))[r.integers(0, 20, n)] * 30 + r.normal(size=(n, dims)) * 0.1
    if kind == "ties":
        return r.integers(0, 3, (n, dims)).astype(float)
    if kind == "hot":  # a third of the rows is one point
        x = r.normal(size=(n, dims))
        x[: n // 3] = 1.5
        return x
    if kind == "far":
        return r.normal(size=(n, dims)) + 1e6
    return r.normal(size=(n, dims))


@pytest.mark.parametrize("kind", ["clusters", "ties", "hot", "far", "noise"])
@pytest.mark.parametrize("cells", [None, 40])
def test_equal_neighbours(spark, kind, cells):
    r = np.random.default_rng(7)
    X = shapes(kind, 700, 6, r)
    T, Q = X[:600], X[600:]
    ref = spark.createDataFrame([(i, x.tolist(), 0, 0, "e") for i, x in enumerate(T)], SCHEMA).repartition(3)
    qry = spark.createDataFrame([(10_000 + i, x.tolist(), 0, 0, "e") for i, x in enumerate(Q)], SCHEMA)
    got = {}
    for row in K.neighbours(ref, qry, 5, ref_block=50, query_block=30, cells=cells).orderBy("qid", "rank").collect():
        got.setdefault(row["qid"] - 10_000, []).append(row["cid"])
    assert [got[i] for i in range(len(Q))] == by_hand(T, Q, 5)


def test_folds_never_meet(spark):
    r = np.random.default_rng(8)
    X, g = shapes("clusters", 400, 4, r), r.integers(0, 3, 400)
    g[:150] = 0  # whole cells of one fold
    rows = spark.createDataFrame([(i, x.tolist(), 0, int(f), "e") for i, (x, f) in enumerate(zip(X, g))], SCHEMA)
    got = {}
    for row in K.neighbours(rows, rows, 4, group="fold", cells=30).orderBy("qid", "rank").collect():
        got.setdefault(row["qid"], []).append(row["cid"])
    assert [got[i] for i in range(400)] == by_hand(X, X, 4, g, g)


def test_clustered_data_skips_cells(spark):
    r = np.random.default_rng(9)
    X = shapes("clusters", 4_000, 8, r)
    rows = spark.createDataFrame([(i, x.tolist(), 0, 0, "e") for i, x in enumerate(X)], SCHEMA)
    seen = {}
    K.neighbours(rows, rows, 5, cells=64, seen=seen).count()
    skipped = 1 - seen["visits"] / seen["pairs"]
    print(f"cells skipped: {skipped:.3f}")
    assert skipped > 0.7


def test_few_rows_and_none(spark):
    few = spark.createDataFrame([(i, [float(i)], i % 2, 0, "e") for i in range(3)], SCHEMA)
    assert K.neighbours(few, few, 5).count() == 9
    assert K.neighbours(few.limit(0), few, 5).count() == 0
    assert K.neighbours(few, few.limit(0), 5).count() == 0


def test_bounds_hold():
    r = np.random.default_rng(1)
    Q, P = r.normal(size=(50, 5)) + 1e4, r.normal(size=(9, 5)) + 1e4
    low, high = pivot_distances(Q, P)
    d = np.sqrt(((Q[:, None] - P[None]) ** 2).sum(2))
    assert (low <= d).all() and (d <= high).all()
    assert cell_count(0) == 1 and cell_count(10**12) == 4_096 and cell_count(2_000) == 16
