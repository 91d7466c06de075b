"""Exact k-nearest-neighbour classification (M2) and its grid search (G1).

Reference rows lie in the cells of a metric index (``metric_index``).  A query first
visits the nearest cells that hold enough rows, then a few cells with the least bounds,
then every other cell whose bound is within its k-th distance so far; the rest can't hold
a nearer row.  In a visit a bounded block of queries meets a bounded block of a cell in
one cogroup task, which computes the distances in numpy and emits only its own top-k
per query - never all pairs as rows, and no query row passes through the driver.  A
row is copied once for each cell that is not excluded; where nothing can be excluded
that is every cell, as in a block grid.  A window per query merges the lists and a
grouped count votes; vote ties go to the smallest label.
Distances are exact Euclidean, ties broken by the reference key: the expanded form
and the bounds only rule rows out, beyond their rounding error.  So neither cells nor
blocks nor the number of partitions change the result.
"""
from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .metric_index import Cells, build_index, cells_to_visit

CAND_SCHEMA = "qid long, cid long, clabel int, dist double"
CANDIDATE = ("qid", "cid", "clabel", "dist")
STEP = 8  # cells of the second wave


def _block_topk(k: int, has_group: bool, chunk: int = 256):
    """Exact k nearest rows of one block for one block of queries.

    Both sides are centred on the block's mean, so large offsets cancel before
    the expanded form |q|^2 + |t|^2 - 2qt is taken.  Its rounding error is
    bounded by eps times the squared lengths; every row whose expanded distance
    is within twice that bound of the k-th smallest stays a candidate - with ties
    that is as many as there are - and all candidates are ranked by
    (sum((q - t)^2), key) in one sort per chunk.
    """
    def run(ref: pd.DataFrame, qry: pd.DataFrame) -> pd.DataFrame:
        if ref.empty or qry.empty:
            return pd.DataFrame({"qid": qry["qid"].iloc[0:0], "cid": ref["cid"].iloc[0:0],
                                 "clabel": ref["clabel"].iloc[0:0], "dist": np.array([], np.float64)})
        T = np.stack(ref["f"].to_numpy()).astype(np.float64)
        Qall = np.stack(qry["f"].to_numpy()).astype(np.float64)
        order = np.argsort(ref["cid"].to_numpy(), kind="stable")  # the key decides ties
        ref, T = ref.iloc[order], T[order]
        centre = T.mean(0)
        Tc = T - centre
        T2 = (Tc * Tc).sum(1)
        tg = ref["g"].to_numpy() if has_group else None
        qg = qry["g"].to_numpy() if has_group else None
        slack = 8.0 * (T.shape[1] + 2) * np.finfo(np.float64).eps
        at_q, at_t, dist = [], [], []
        for s0 in range(0, Qall.shape[0], chunk):  # bounded distance matrix: chunk x block
            Q = Qall[s0:s0 + chunk]
            Qc = Q - centre
            Q2 = (Qc * Qc).sum(1)
            d2 = Q2[:, None] + T2[None, :] - 2.0 * (Qc @ Tc.T)
            if has_group:
                d2[qg[s0:s0 + chunk][:, None] == tg[None, :]] = np.inf
            m = min(k, T.shape[0])
            kth = np.partition(d2, m - 1, axis=1)[:, m - 1]
            err = slack * (Q2[:, None] + T2[None, :])
            near = np.isfinite(d2) & ~(d2 - err > (kth + slack * (Q2 + T2.max()))[:, None])
            qi, ti = np.nonzero(near)
            exact = np.empty(len(qi))
            for lo in range(0, len(qi), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                exact[part] = ((T[ti[part]] - Q[qi[part]]) ** 2).sum(1)
            by = np.lexsort((ti, exact, qi))
            qi, ti, exact = qi[by], ti[by], exact[by]
            rank = np.arange(len(qi)) - np.searchsorted(qi, qi)
            keep = rank < k
            at_q.append(qi[keep] + s0)
            at_t.append(ti[keep])
            dist.append(np.sqrt(exact[keep]))
        q, t = np.concatenate(at_q), np.concatenate(at_t)
        return pd.DataFrame({"qid": qry["qid"].to_numpy()[q], "cid": ref["cid"].to_numpy()[t],
                             "clabel": ref["clabel"].to_numpy()[t], "dist": np.concatenate(dist)})
    return run


def _meet(rows: DataFrame, index: Cells, visits: DataFrame, k: int, grouped: bool, query_block: int) -> DataFrame:
    """Top-k lists of every (block of a cell, block of its queries)."""
    per = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / query_block).cast("int").alias("_of"))  # a row a cell
    per = F.broadcast(per)
    r = rows.join(per, "cell").withColumn("_qb", F.explode(F.sequence(F.lit(0), F.col("_of") - 1))).drop("_of")
    subs = F.element_at(F.array(*(F.lit(int(b)) for b in index.blocks)), F.col("cell") + 1)
    q = (visits.join(per, "cell").withColumn("_qb", F.pmod(F.xxhash64("qid"), F.col("_of")).cast("int"))
         .withColumn("sub", F.explode(F.sequence(F.lit(0), subs - 1))).drop("_of"))
    return (r.groupBy("cell", "sub", "_qb").cogroup(q.groupBy("cell", "sub", "_qb"))
            .applyInPandas(_block_topk(k, grouped), CAND_SCHEMA))


def neighbours(ref: DataFrame, query: DataFrame, k: int, key: str = "id", label: str = "label",
               features: str = "features", group: str | None = None, ref_block: int = 20000,
               query_block: int = 2000, cells: int | None = None, seen: dict | None = None) -> DataFrame:
    """(qid, rank, cid, clabel, dist): the k nearest reference rows of every query.

    With ``group`` set, a query never matches a reference row of its own group
    (cross-validation folds).  ``seen`` receives the number of (query, cell) visits and of
    all such pairs.
    """
    g = [F.col(group).cast("long").alias("g")] if group else []
    rows = ref.select(F.col(key).cast("long").alias("cid"), F.col(label).cast("int").alias("clabel"),
                      F.col(features).alias("f"), *g)
    queries = query.select(F.col(key).cast("long").alias("qid"), F.col(features).alias("f"), *g)
    n = rows.count()
    if n == 0:
        return ref.sparkSession.createDataFrame([], CAND_SCHEMA).withColumn("rank", F.lit(0))
    rows, index = build_index(rows, n, ref_block, cells)
    need = k if group is None else 2 * k
    best, visited = None, 0
    visit = T.StructType([*queries.schema, T.StructField("cell", T.IntegerType())])
    by_query = Window.partitionBy("qid").orderBy("dist", "cid")
    for wave in range(3 if len(index.pivots) > 1 else 1):
        asking = queries
        if wave:
            tau = best.groupBy("qid").agg(F.when(F.count(F.lit(1)) >= k, F.max("dist")).alias("tau"), F.max("tau0").alias("tau0"))
            asking = queries.join(tau, "qid", "left").fillna(float("inf"), ["tau", "tau0"])
        visits = materialize(asking.mapInPandas(cells_to_visit(index, wave, need, STEP), visit), "knn-visits")
        visited += visits.count()
        found = _meet(rows, index, visits, k, group is not None, query_block)
        if wave:
            found = best.select(*CANDIDATE).unionByName(found).join(best.groupBy("qid").agg(F.max("tau0").alias("tau0")), "qid", "left")
        found = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
        if wave == 0:
            every = Window.partitionBy("qid")
            found = found.withColumn("tau0", F.when(F.count(F.lit(1)).over(every) >= k, F.max("dist").over(every)).otherwise(float("inf")))
        best = materialize(found, "knn-best")
    if seen is not None:
        seen.update(visits=visited, pairs=queries.count() * int((index.sizes > 0).sum()))
    return best.select("qid", "rank", "cid", "clabel", "dist")


def vote(nb: DataFrame, k: int) -> DataFrame:
    """Majority label among the first ``k`` neighbours; ties -> smallest label."""
    counts = nb.where(F.col("rank") <= k).groupBy("qid", "clabel").agg(F.count(F.lit(1)).alias("votes"))
    return counts.groupBy("qid").agg(
        (-F.max(F.struct(F.col("votes"), -F.col("clabel")))["col2"]).cast("int").alias("pred"))


def knn_predict(ref: DataFrame, query: DataFrame, k: int = 5, key: str = "id", label: str = "label",
                features: str = "features") -> DataFrame:
    """(key, label, pred) for every query row (M2)."""
    nb = neighbours(ref, query, k, key, label, features)
    return (query.select(key, label).join(vote(nb, k).withColumnRenamed("qid", key), key))


def knn_grid(train: DataFrame, ks: Sequence[int] = (3, 5, 7, 9), fold: str = "fold", key: str = "id",
             label: str = "label", features: str = "features") -> DataFrame:
    """Cross-validated accuracy per k (G1): neighbours are found once with max(k)
    against the other folds, every k is scored from the same lists.
    (k, mean_accuracy, std_accuracy, rank)."""
    kmax = max(ks)
    # one neighbour search, written once and read by the vote of every k
    nb = materialize(neighbours(train, train, kmax, key, label, features, group=fold), "knn-grid-neighbours")
    truth = train.select(F.col(key).alias("qid"), F.col(label).alias("y"), F.col(fold).alias("f"))
    per = None
    for k in ks:
        acc = (vote(nb, k).join(truth, "qid").groupBy("f")
                  .agg(F.avg((F.col("pred") == F.col("y")).cast("double")).alias("acc"))
                  .withColumn("k", F.lit(k)))
        per = acc if per is None else per.unionByName(acc)
    # one row per k: the ranking window below runs over len(ks) rows
    summary = per.groupBy("k").agg(F.avg("acc").alias("mean_accuracy"), F.stddev_pop("acc").alias("std_accuracy"))
    return summary.withColumn("rank", F.rank().over(Window.orderBy(F.desc("mean_accuracy"), F.asc("k"))).cast("int"))


def knn_grid_test(train: DataFrame, test: DataFrame, ks: Sequence[int] = (3, 5, 7, 9), fold: str = "fold",
                  key: str = "id", label: str = "label", features: str = "features") -> DataFrame:
    """(best_k, cv_accuracy, test_accuracy, n_test): the best k of the grid, refitted on all
    of ``train`` and scored on ``test``."""
    best = knn_grid(train, ks, fold, key, label, features).where("rank = 1").first()  # one row
    pred = knn_predict(train, test, best["k"], key, label, features)
    return pred.agg(F.lit(best["k"]).alias("best_k"), F.lit(best["mean_accuracy"]).alias("cv_accuracy"),
                    F.avg((F.col("pred") == F.col(label)).cast("double")).alias("test_accuracy"),
                    F.count(F.lit(1)).alias("n_test"))
