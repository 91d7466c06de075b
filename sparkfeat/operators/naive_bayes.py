"""Gaussian naive Bayes as plain DataFrame aggregation (M7).

fit: class prior, per-(class, feature) mean and population variance, plus
var_smoothing * max feature variance added to every variance.  The fitted
statistics are a (class x feature) table - bounded by the model, not the data.
predict: the joint log-likelihood
    ln prior_c - 1/2 sum_d [ln(2 pi var_cd) + (x_d - mu_cd)^2 / var_cd]
per class in one projection over the row's feature array; the prediction is the arg max (smallest class on ties) and the
probability of every class comes from a log-sum-exp.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GaussianNB:
    def __init__(self, features: str = "features", label: str = "label", key: str = "id",
                 var_smoothing: float = 1e-9):
        self.features, self.label, self.key, self.var_smoothing = features, label, key, var_smoothing

    def fit(self, df: DataFrame) -> "GaussianNBModel":
        long = df.select(self.key, self.label, F.posexplode(self.features).alias("d", "x")) \
                 .withColumn("x", F.col("x").cast("double"))
        eps = long.groupBy("d").agg(F.var_pop("x").alias("v")).agg(F.max("v")).first()[0] * self.var_smoothing
        n = df.count()
        prior = df.groupBy(self.label).agg((F.count(F.lit(1)) / F.lit(n)).alias("prior"))
        stats = (long.groupBy(self.label, "d").agg(F.avg("x").alias("mu"), (F.var_pop("x") + F.lit(eps)).alias("var"))
                     .join(prior, self.label))
        rows = stats.collect()  # classes x features: the model itself
        return GaussianNBModel(self, [(r[self.label], r["d"], r["mu"], r["var"], r["prior"]) for r in rows])


class GaussianNBModel:
    def __init__(self, est: GaussianNB, stats):
        self.est, self.stats = est, stats

    def _classes(self):
        """(class, ln prior - 1/2 sum ln(2 pi var), [(mu, 1 / var) by feature]), class order."""
        by = {}
        for cls, d, mu, var, prior in self.stats:
            by.setdefault(cls, []).append((d, mu, var, prior))
        out = []
        for cls in sorted(by):
            rows = sorted(by[cls])
            const = math.log(rows[0][3]) - 0.5 * sum(math.log(2 * math.pi * var) for _, _, var, _ in rows)
            out.append((cls, const, [(mu, 1.0 / var) for _, mu, var, _ in rows]))
        return out

    def _scores(self):
        """array<double> of joint log-likelihoods in class order: a projection of the row's
        own features against the model's literal arrays, without an exchange."""
        x = F.transform(F.col(self.est.features), lambda v: v.cast("double"))

        def literal(values):
            return F.expr(f"array({', '.join(f'{v!r}D' for v in values)})")

        def score(const, params):
            off = F.zip_with(x, literal([m for m, _ in params]), lambda v, m: v - m)
            far = F.zip_with(off, literal([i for _, i in params]), lambda v, i: v * v * i)
            return F.lit(const) - 0.5 * F.aggregate(far, F.lit(0.0), lambda acc, v: acc + v)

        return F.array(*[score(const, params) for _, const, params in self._classes()])

    def class_scores(self, df: DataFrame) -> DataFrame:
        """(key, scores array<double>): joint log-likelihoods in class order."""
        return df.select(self.est.key, self._scores().alias("scores"))

    def predict(self, df: DataFrame, keep=("label",)) -> DataFrame:
        """(key, kept columns, pred, p_true?); ``p_true`` when the label is kept.

        One projection: scores, arg max (smallest class on ties) and log-sum-exp are
        array functions of the row."""
        key, lab = self.est.key, self.est.label
        keep = list(keep)
        classes = F.array(*[F.lit(c) for c, _, _ in self._classes()])
        scored = df.select(key, *keep, self._scores().alias("_s")).withColumn("_m", F.array_max("_s"))
        out = scored.withColumn("pred", F.element_at(classes, F.array_position("_s", F.col("_m")).cast("int")).cast("int"))
        if lab in keep:
            lse = F.col("_m") + F.log(F.aggregate(F.transform("_s", lambda v: F.exp(v - F.col("_m"))), F.lit(0.0),
                                                  lambda acc, v: acc + v))
            own = F.array_position(classes, F.col(lab).cast("int")).cast("int")
            out = out.withColumn("p_true", F.when(own > 0, F.exp(F.get("_s", own - 1) - lse)))
        return out.drop("_s", "_m")
