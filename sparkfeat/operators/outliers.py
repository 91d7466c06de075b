"""Outlier flags (O1, O2, O4).  The isolation forest (O3) is in ``isoforest``."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .profile import iqr_rows  # noqa: F401  (O1)
from .rolling import rolling


def zscore_outliers(df: DataFrame, cols: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Adds ``max_abs_z`` (population sd, ddof=0) and ``is_outlier`` = max |z| > limit (O2).

    A constant or empty column has no z and takes no part; without any z the
    maximum is null and the row is no outlier."""
    r = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{i}") for i, c in enumerate(cols)],
               *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    zs = [F.abs((F.col(c).cast("double") - F.lit(r[f"m_{i}"])) / F.lit(r[f"s_{i}"]))
          if r[f"s_{i}"] else F.lit(None).cast("double") for i, c in enumerate(cols)]
    mz = zs[0] if len(zs) == 1 else F.greatest(*zs)
    return df.withColumn("max_abs_z", mz).withColumn("is_outlier", F.coalesce(F.col("max_abs_z") > F.lit(limit), F.lit(False)))


def smooth(df: DataFrame, cols: Sequence[str], order: Sequence[str], w: int = 3, partition_by=None) -> DataFrame:
    """Rolling mean with partial frames as a smoother, replacing the columns."""
    out = rolling(df, cols, order, [w], fns=("mean",), min_periods=1, partition_by=partition_by,
                  name="{col}__smooth")
    for c in cols:
        out = out.withColumn(c, F.col(f"{c}__smooth")).drop(f"{c}__smooth")
    return out
