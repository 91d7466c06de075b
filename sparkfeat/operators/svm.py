"""Linear support vector machines of all classes in the same passes (M5, M6).

``OneVsRest`` fits a binary machine per class, several at a time, each with a copy of the
training table of its own, cut into blocks; behind a kernel map that is 512 numbers a row.
``JointSVM`` solves the same problems (hinge loss, L2 on standardized features, L-BFGS with
the stopping rules of Spark's ``LinearSVC``) side by side: a pass gives the losses and
gradients of all classes, and the rows stay as they were before the map, which is made anew
for some rows at a time within a pass.  The result is Spark's own one-vs-rest model."""
from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LinearSVCModel, OneVsRest, OneVsRestModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 2_048  # rows that are mapped at once
MEMORY = 10  # curvature pairs


def minimise(size: int, iterations: int, tol: float):
    """L-BFGS from 0 as a generator: it yields points, is sent (value, gradient) and returns the
    best point.  Steps meet the strong Wolfe conditions; it stops when the last ten values
    differ by no more than ``tol`` of the first one."""
    x = np.zeros(size)
    f, g = yield x
    pairs, values = [], [f]
    for i in range(iterations):
        d, kept = -g, []
        for s, y in reversed(pairs):
            a = (s @ d) / (s @ y)
            d, kept = d - a * y, [a, *kept]
        if pairs:
            s, y = pairs[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y), a in zip(pairs, kept):
            d = d + s * (a - (y @ d) / (s @ y))
        slope = d @ g
        if slope >= 0:
            pairs, d, slope = [], -g, -(g @ g)
        if slope == 0:
            return x
        step, best = (1.0 if pairs else 0.5 / np.sqrt(-slope)), None
        for _ in range(20):
            at = x + step * d
            fn, gn = yield at
            if fn > f + 1e-4 * step * slope:
                step *= 0.1 if i < 1 else 0.5
                continue
            best, now = (at, fn, gn), gn @ d
            if now < 0.9 * slope:
                step *= 2.1
            elif now > -0.9 * slope:
                step *= 0.1 if i < 1 else 0.5
            else:
                break
        if best is None:
            return x
        s, y = best[0] - x, best[2] - g
        if s @ y > 1e-12 * (y @ y):
            pairs = [*pairs, (s, y)][-MEMORY:]
        x, f, g = best
        values.append(f)
        if abs(f - max(values[-MEMORY:])) <= tol * abs(values[0]) or np.sqrt(g @ g) <= max(tol * abs(f), 1e-8):
            return x
    return x


def side_by_side(problems: dict, evaluate) -> dict:
    """The results of generators that yield points; ``evaluate`` takes all points at once."""
    points, done = {i: next(p) for i, p in problems.items()}, {}
    while points:
        for i, got in evaluate(points).items():
            try:
                points[i] = problems[i].send(got)
            except StopIteration as end:
                done[i] = end.value
                del points[i]
    return done


def _pack(batches):
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (
                batch.column(0).flatten().to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64))], names=["x", "y"])


class JointSVM(OneVsRest):
    """``OneVsRest`` over ``LinearSVC`` whose binary machines are fitted in the same passes.
    ``through``: a stage that maps rows to features, by ``basis`` and ``weights``; the model
    then takes what the stage puts out."""

    through = None

    def _fit(self, dataset: DataFrame) -> OneVsRestModel:
        one = self.getClassifier()
        if one.isDefined(one.weightCol) or not (one.getFitIntercept() and one.getStandardization()) or self.isDefined(self.weightCol):
            raise ValueError("not a parameter of this machine")
        d = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        r = d.agg(F.count(F.lit(1)).alias("n"), F.max("y").alias("y"), F.max(F.size("x")).alias("most"), F.min(F.size("x")).alias("least"),
                  F.count_if(F.col("x").isNull() | F.exists("x", lambda v: F.isnan(v) | (F.abs(v) == float("inf")))).alias("bad")).first()
        n, k, dims = r["n"], int(r["y"]) + 1, r["most"]
        if r["bad"] or r["least"] != dims:
            raise ValueError(f"feature vectors of one length and finite values are needed: {r}")
        basis, M = (self.through.basis(), self.through.weights()) if self.through is not None else (None, None)
        rows = d.mapInArrow(_pack, "x binary, y binary").rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
        add = (lambda parts: parts.treeReduce(operator.add)) if rows.getNumPartitions() > 64 else (lambda parts: parts.reduce(operator.add))

        def summed(part, blocks):
            out = 0.0
            for x, y in blocks:
                X, y = np.frombuffer(x).reshape(-1, dims), np.frombuffer(y)
                for i in range(0, len(X), CHUNK):
                    B = X[i:i + CHUNK]
                    out = out + part(basis(B) if basis else B, y[i:i + CHUNK])
            return out

        forward = (lambda v: M @ v) if M is not None else (lambda v: v)  # of coefficients
        back = (lambda v: M.T @ v) if M is not None else (lambda v: v)  # of gradients
        penalty, iterations, tol = one.getRegParam(), one.getMaxIter(), one.getTol()

        def solve(total):
            """Means, scales and points; ``total`` sums ``part(mapped rows, labels)`` over all rows."""
            mean = back(total(lambda B, y: B.sum(0))) / n
            square = total(lambda B, y: (((B if M is None else B @ M) - mean) ** 2).sum(0))
            std = np.sqrt(square / max(n - 1, 1))
            scale = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
            p = len(mean)

            def evaluate(points: dict) -> dict:
                own = np.array(sorted(points), dtype=np.float64)
                at = np.stack([points[i] for i in sorted(points)], 1)
                A, b = forward(at[:p] * scale[:, None]), at[p] - mean @ (at[:p] * scale[:, None])

                def part(B, y):
                    sign = np.where(y[:, None] == own, 1.0, -1.0)
                    slack = 1.0 - sign * (B @ A + b)
                    G = np.where(slack > 0, -sign, 0.0)
                    return np.vstack([np.maximum(slack, 0.0).sum(0), G.sum(0), B.T @ G])

                s = total(part) / n
                gradient = scale[:, None] * (back(s[2:]) - np.outer(mean, s[1])) + penalty * at[:p]
                value = s[0] + 0.5 * penalty * (at[:p] ** 2).sum(0)
                return {i: (value[j], np.r_[gradient[:, j], s[1, j]]) for j, i in enumerate(sorted(points))}

            return mean, scale, side_by_side({i: minimise(p + 1, iterations, tol) for i in range(k)}, evaluate)

        try:
            if rows.getNumPartitions() == 1:  # a small table: all passes in its one task
                mean, scale, found = rows.mapPartitions(lambda blocks: [solve(lambda part, own=[*blocks]: summed(part, own))]).collect()[0]
            else:
                def one_task(part):
                    return lambda blocks: [x for x in [summed(part, blocks)] if np.ndim(x)]
                mean, scale, found = solve(lambda part: add(rows.mapPartitions(one_task(part))))
        finally:
            rows.unpersist()
        p = len(mean)
        sc, models = dataset.sparkSession.sparkContext, []
        for i in range(k):
            w = found[i][:p] * scale
            binary = one.copy({one.featuresCol: self.getFeaturesCol(), one.predictionCol: self.getPredictionCol()})
            java = sc._jvm.org.apache.spark.ml.classification.LinearSVCModel(f"{one.uid}_{i}", _py2java(sc, Vectors.dense(w)), float(found[i][p] - mean @ w))
            models.append(binary._copyValues(LinearSVCModel(java)))
        return self._copyValues(OneVsRestModel(models=models))
