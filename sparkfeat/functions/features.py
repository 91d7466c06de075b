"""Per-column feature tables.

Each table has one row per column (the reference transposes a dict of dicts)
and comes from one aggregation pass, plus the exact median, the 20-bin
histogram for the entropy, and the global-order sign changes for the
zero-crossing rate.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.profile import histogram
from ..operators.ranks import quantile_values
from ..operators.rolling import sign_changes


def _one_row_long(stats: DataFrame, cols: Sequence[str], fields) -> DataFrame:
    parts = [F.struct(F.lit(c).alias("column"), *[expr(c).alias(name) for name, expr in fields]) for c in cols]
    return stats.select(F.inline(F.array(*parts)))


def histogram_entropy(df: DataFrame, cols: Sequence[str], bins: int = 20) -> DataFrame:
    """Natural-log entropy of the histogram counts + 1 (F7): ln S - sum((c+1) ln(c+1)) / S."""
    h = histogram(df, cols, bins).withColumn("c1", F.col("count") + 1)
    return h.groupBy("column").agg(
        (F.log(F.sum("c1")) - F.sum(F.col("c1") * F.log("c1")) / F.sum("c1")).alias("entropy"))


def statistical_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """mean, median, variance, std (ddof=0), rms, energy, entropy, kurtosis, skewness."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"mean_{i}"), F.var_pop(x).alias(f"var_{i}"), F.stddev_pop(x).alias(f"std_{i}"),
                 F.sqrt(F.avg(x * x)).alias(f"rms_{i}"), F.sum(x * x).alias(f"energy_{i}"),
                 F.kurtosis(x).alias(f"kurt_{i}"), F.skewness(x).alias(f"skew_{i}")]
    med = quantile_values(df, cols, [0.5], "linear")
    stats = df.agg(*aggs)
    idx = {c: i for i, c in enumerate(cols)}
    long = _one_row_long(stats, cols, [
        ("mean", lambda c: F.col(f"mean_{idx[c]}")),
        ("median", lambda c: F.lit(med[(c, 0.5)]).cast("double")),
        ("variance", lambda c: F.col(f"var_{idx[c]}")),
        ("std", lambda c: F.col(f"std_{idx[c]}")),
        ("rms", lambda c: F.col(f"rms_{idx[c]}")),
        ("energy", lambda c: F.col(f"energy_{idx[c]}")),
        ("kurtosis", lambda c: F.col(f"kurt_{idx[c]}")),
        ("skewness", lambda c: F.col(f"skew_{idx[c]}")),
    ])
    return long.join(histogram_entropy(df, cols, 20), "column").select(
        "column", "mean", "median", "variance", "std", "rms", "energy", "entropy", "kurtosis", "skewness")


def time_features(df: DataFrame, cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """peak, peak-to-peak, zero-crossing rate, signal magnitude area."""
    flagged = sign_changes(df.select(*order, *cols), cols, order)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.max(x).alias(f"peak_{i}"), (F.max(x) - F.min(x)).alias(f"ptp_{i}"),
                 (F.count_if(F.col(f"{c}_sign_change")) / F.count(F.lit(1))).alias(f"zcr_{i}"),
                 F.sum(F.abs(x)).alias(f"sma_{i}")]
    stats = flagged.agg(*aggs)
    idx = {c: i for i, c in enumerate(cols)}
    return _one_row_long(stats, cols, [
        ("peak", lambda c: F.col(f"peak_{idx[c]}")),
        ("peak_to_peak", lambda c: F.col(f"ptp_{idx[c]}")),
        ("zero_crossing_rate", lambda c: F.col(f"zcr_{idx[c]}")),
        ("signal_magnitude_area", lambda c: F.col(f"sma_{idx[c]}")),
    ])


def spectral_closed_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Spectral energy sum|X_k|^2 = n sum x^2 (Parseval, F16) and the mean of the
    one-sided, mean-removed periodogram = n var_pop / (floor(n/2) + 1) (F18)."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        n = F.count(x)
        aggs += [(n * F.sum(x * x)).alias(f"se_{i}"),
                 (n * F.var_pop(x) / (F.floor(n / 2) + 1)).alias(f"psd_{i}")]
    stats = df.agg(*aggs)
    idx = {c: i for i, c in enumerate(cols)}
    return _one_row_long(stats, cols, [
        ("spectral_energy", lambda c: F.col(f"se_{idx[c]}")),
        ("mean_psd", lambda c: F.col(f"psd_{idx[c]}")),
    ])


def feature_table(df: DataFrame, cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Statistical, time and closed-form spectral features joined by column."""
    return (statistical_features(df, cols)
            .join(time_features(df, cols, order), "column")
            .join(spectral_closed_features(df, cols), "column"))
