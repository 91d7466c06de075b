"""Scalers (N1-N6) as fitted, saveable transforms with an inverse.

``fit`` is one aggregation pass (plus the exact rank selection for the robust
scaler); the fitted centre and scale per column are a few numbers held by the
model, exactly like ``pyspark.ml`` scalers.  ``transform`` and ``inverse`` are
one projection with literals, inside whole-stage codegen.

kinds:
  minmax       (x-min)/(max-min); a constant column gives NaN      (N1)
  minmax_safe  same; a constant column gives 0                      (N3)
  standard     (x-mean)/sd, ``ddof`` 1 (N2, zero sd -> NaN) or 0 (N4, zero sd -> scale 1)
  robust       (x-median)/(q75-q25), exact linear quantiles; zero IQR -> scale 1 (N5)
  maxabs       x/max|x|; an all-zero column -> scale 1              (N6)
"""
from __future__ import annotations

import json
from typing import Dict, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import quantile_values

KINDS = ("minmax", "minmax_safe", "standard", "robust", "maxabs")


class Scaler:
    def __init__(self, kind: str, cols: Sequence[str], ddof: int = 1):
        if kind not in KINDS:
            raise ValueError(f"unknown scaler {kind}")
        self.kind, self.cols, self.ddof = kind, list(cols), ddof

    def fit(self, df: DataFrame) -> "ScalerModel":
        k, cols = self.kind, self.cols
        params: Dict[str, tuple] = {}
        if k in ("minmax", "minmax_safe"):
            r = df.agg(*[F.min(F.col(c).cast("double")).alias(f"mn_{i}") for i, c in enumerate(cols)],
                       *[F.max(F.col(c).cast("double")).alias(f"mx_{i}") for i, c in enumerate(cols)]).first()
            for i, c in enumerate(cols):
                mn, mx = r[f"mn_{i}"], r[f"mx_{i}"]
                rng = None if mn is None else mx - mn
                if rng == 0:
                    params[c] = (mn, float("nan") if k == "minmax" else 0.0, "const")
                else:
                    params[c] = (mn, rng, "div")
        elif k == "standard":
            sd = F.stddev_samp if self.ddof == 1 else F.stddev_pop
            r = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{i}") for i, c in enumerate(cols)],
                       *[sd(F.col(c).cast("double")).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
            for i, c in enumerate(cols):
                m, s = r[f"m_{i}"], r[f"s_{i}"]
                if s == 0 or s is None:
                    params[c] = (m, float("nan"), "const") if self.ddof == 1 else (m, 1.0, "div")
                else:
                    params[c] = (m, s, "div")
        elif k == "robust":
            qv = quantile_values(df, cols, [0.25, 0.5, 0.75], "linear")
            for c in cols:
                iqr = None if qv[(c, 0.75)] is None else qv[(c, 0.75)] - qv[(c, 0.25)]
                params[c] = (qv[(c, 0.5)], 1.0 if iqr == 0 else iqr, "div")
        elif k == "maxabs":
            r = df.agg(*[F.max(F.abs(F.col(c).cast("double"))).alias(f"a_{i}") for i, c in enumerate(cols)]).first()
            for i, c in enumerate(cols):
                a = r[f"a_{i}"]
                params[c] = (0.0, 1.0 if not a else a, "div")
        return ScalerModel(self.kind, cols, params)


class ScalerModel:
    def __init__(self, kind: str, cols: Sequence[str], params: Dict[str, tuple]):
        self.kind, self.cols, self.params = kind, list(cols), params

    def _fwd(self, c: str):
        center, scale, how = self.params[c]
        x = F.col(c).cast("double")
        if how == "const":  # zero range: a fixed output for every non-null value
            return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.lit(scale))
        return (x - F.lit(center)) / F.lit(scale)

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns({c + suffix: self._fwd(c) for c in self.cols})

    def inverse(self, df: DataFrame, suffix: str = "") -> DataFrame:
        out = {}
        for c in self.cols:
            center, scale, how = self.params[c]
            s = 0.0 if how == "const" else scale
            out[c + suffix] = F.col(c).cast("double") * F.lit(s) + F.lit(center)
        return df.withColumns(out)

    def stats(self, spark) -> DataFrame:
        rows = [(c, float(self.params[c][0]) if self.params[c][0] is not None else None,
                 float(self.params[c][1]) if self.params[c][1] is not None else None) for c in self.cols]
        return spark.createDataFrame(rows, "column string, center double, scale double")

    # ---- persistence: a one-row JSON document written with Spark
    def save(self, spark, path: str) -> None:
        doc = json.dumps({"kind": self.kind, "cols": self.cols, "params": self.params})
        spark.createDataFrame([(doc,)], "doc string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark, path: str) -> "ScalerModel":
        doc = json.loads(spark.read.text(path).first()[0])
        return cls(doc["kind"], doc["cols"], {k: tuple(v) for k, v in doc["params"].items()})
