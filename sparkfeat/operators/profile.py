"""Profiling, counting and reshaping.

Each profile is one aggregation pass over the table (partial aggregation on
the map side, one tiny final task), plus the two-pass exact rank selection of
``ranks`` for quantiles.  Scalars that a later row pass needs (fences, bin
edges) are computed once and enter that pass as literals.
"""
from __future__ import annotations

from typing import Dict, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .gram import correlations
from .ranks import quantile_values

FIXED_WIDTH = {  # bytes per non-null value of fixed-width types
    "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4,
    "double": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8,
}


# ---------------------------------------------------------------- A1, A2, A19
def shape(df: DataFrame, label: str | None = None) -> DataFrame:
    """Rows, columns and features (columns minus the label) in one row."""
    ncols = len(df.columns)
    nfeat = ncols - (1 if label is not None else 0)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(ncols).alias("n_cols"), F.lit(nfeat).alias("n_features"))


def size_estimate(df: DataFrame, n_features: int, bytes_per_value: int = 4) -> DataFrame:
    """rows x features x 4 bytes, in bytes and KB."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(n_features).alias("n_features"),
        (F.col("n_rows") * n_features * bytes_per_value).cast("long").alias("bytes"),
        (F.col("n_rows") * n_features * bytes_per_value / 1024.0).alias("kb"))


def schema_table(df: DataFrame) -> DataFrame:
    """Column position, name and type (A2); one row per column."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


# ---------------------------------------------------------------- A3 - A12
def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, nulls, mean, sd (ddof=1), min, exact quartiles, max per column (A3)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.count_if(x.isNull()).alias(f"{c}__nulls"),
                 F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    qv = quantile_values(df, cols, [0.25, 0.5, 0.75], "linear")
    stats = df.agg(*aggs)
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"{c}__count").alias("count"),
                      F.col(f"{c}__nulls").alias("nulls"), F.col(f"{c}__mean").alias("mean"),
                      F.col(f"{c}__std").alias("std"), F.col(f"{c}__min").alias("min"),
                      F.lit(qv[(c, 0.25)]).cast("double").alias("q25"),
                      F.lit(qv[(c, 0.5)]).cast("double").alias("median"),
                      F.lit(qv[(c, 0.75)]).cast("double").alias("q75"),
                      F.col(f"{c}__max").alias("max")) for c in cols]
    return stats.select(F.inline(F.array(*parts)))


def null_counts(df: DataFrame, total: bool = True) -> DataFrame:
    """Nulls per column and in total, one pass (A4)."""
    stats = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("long").alias("null_count"))
             for c in df.columns]
    if total:
        parts.append(F.struct(F.lit("__total__").alias("column"),
                              sum((F.col(f"`{c}`") for c in df.columns), F.lit(0)).cast("long").alias("null_count")))
    return stats.select(F.inline(F.array(*parts)))


def duplicate_count(df: DataFrame) -> DataFrame:
    """n - n_unique over full rows; null fields compare equal (A5)."""
    return dedup_report(df).select(F.col("removed").alias("duplicates"))


def dedup(df: DataFrame) -> DataFrame:
    """Drop full-row duplicates."""
    return df.dropDuplicates()


def _fingerprint(columns) -> list:
    """Two 64-bit hashes of a row of different seeds; null is told from every value."""
    parts = [x for c in columns for x in (c.isNull(), c)]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def dedup_report(df: DataFrame, fingerprint=_fingerprint) -> DataFrame:
    """Rows before, after and removed (D2); null fields compare equal, like ``dropDuplicates``.

    Rows are counted by 128-bit fingerprints, combined before the exchange: 16 bytes of a
    row and its count move, not the row.  A third hash (other seed, other function) tells
    fingerprints that different rows share; only the rows of those are compared by value.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    h1, h2 = fingerprint(cols)
    check = F.hash(*(x for c in cols for x in (c.isNull(), c)))
    prints = df.select(h1.alias("h1"), h2.alias("h2"), check.alias("c")).groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    prints = materialize(prints, "row-prints")
    total = prints.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("before"),
                       F.count_if(F.col("lo") == F.col("hi")).alias("alone"))
    shared = prints.where("lo < hi").select("h1", "h2")
    rows = df.select(F.struct(*[c.alias(f"v{i}") for i, c in enumerate(cols)]).alias("row"), h1.alias("h1"), h2.alias("h2"))
    values = rows.join(shared, ["h1", "h2"]).agg(F.count_distinct("row").alias("values")) if not shared.isEmpty() else \
        df.sparkSession.range(1).select(F.lit(0).cast("long").alias("values"))
    after = (F.col("alone") + F.col("values")).cast("long")
    return total.crossJoin(values).select("before", after.alias("after"), (F.col("before") - after).alias("removed"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values."""
    return df.select(col).distinct().orderBy(col)


def class_balance(df: DataFrame, col: str, by: str = "key") -> DataFrame:
    """Group count ordered by key (A7) or by count descending."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if by == "key":
        return g.orderBy(col)
    return g.orderBy(F.desc("count"), F.asc(col))


def quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], method: str = "linear") -> DataFrame:
    """Exact quantiles as a (column, q, value) table (A11 nearest, A12 linear)."""
    qv = quantile_values(df, cols, qs, method)
    counts = df.agg(F.count(F.lit(1)).alias("_n"))
    parts = [F.struct(F.lit(c).alias("column"), F.lit(float(q)).alias("q"),
                      F.lit(qv[(c, q)]).cast("double").alias("value")) for c in cols for q in qs]
    return counts.select(F.inline(F.array(*parts)))


# ---------------------------------------------------------------- A13, A14, A16, O1
def iqr_fences(df: DataFrame, cols: Sequence[str], k: float = 1.5, qv=None) -> Dict[str, tuple]:
    """Linear quartiles and fences per column: (q1, q3, iqr, lower, upper); all None for
    a column without values."""
    qv = qv or quantile_values(df, cols, [0.25, 0.75], "linear")
    out = {}
    for c in cols:
        q1, q3 = qv[(c, 0.25)], qv[(c, 0.75)]
        if q1 is None or q3 is None:
            out[c] = (None,) * 5
            continue
        iqr = q3 - q1
        out[c] = (q1, q3, iqr, q1 - k * iqr, q3 + k * iqr)
    return out


def _outside(c: str, fence: tuple):
    return F.lit(False) if fence[3] is None else (F.col(c) < fence[3]) | (F.col(c) > fence[4])


def iqr_counts(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Fences and outlier count per column, one counting pass."""
    fences = iqr_fences(df, cols, k)
    aggs = [F.count_if(_outside(c, fences[c])).alias(c) for c in cols]
    counts = df.agg(*aggs)
    parts = [F.struct(F.lit(c).alias("column"), F.lit(fences[c][0]).cast("double").alias("q1"),
                      F.lit(fences[c][1]).cast("double").alias("q3"),
                      F.lit(fences[c][2]).cast("double").alias("iqr"),
                      F.lit(fences[c][3]).cast("double").alias("lower"),
                      F.lit(fences[c][4]).cast("double").alias("upper"),
                      F.col(c).cast("long").alias("n_outliers")) for c in cols]
    return counts.select(F.inline(F.array(*parts)))


def iqr_cells(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Outlier cells summed over columns; a row can count several times."""
    return iqr_counts(df, cols, k).agg(F.sum("n_outliers").cast("long").alias("outlier_cells"))


def iqr_rows(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Rows outside the fences of at least one column, with how many (O1, P5)."""
    fences = iqr_fences(df, cols, k)
    flags = [F.coalesce(_outside(c, fences[c]).cast("int"), F.lit(0)) for c in cols]
    n = sum(flags[1:], flags[0])
    return df.withColumn("n_outlier_cols", n).where(F.col("n_outlier_cols") > 0)


def box_numbers(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Box-plot numbers: quartiles, whiskers (extreme data inside the fences), fliers."""
    qv = quantile_values(df, cols, [0.25, 0.5, 0.75], "linear")
    fences = iqr_fences(df, cols, k, qv)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        lo, hi = fences[c][3], fences[c][4]
        inside = (x >= lo) & (x <= hi)
        aggs += [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 F.min(F.when(inside, x)).alias(f"{c}__wlo"), F.max(F.when(inside, x)).alias(f"{c}__whi"),
                 F.count_if(~inside).alias(f"{c}__fl")]
    stats = df.agg(*aggs)
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"{c}__min").alias("min"),
                      F.lit(fences[c][0]).cast("double").alias("q1"),
                      F.lit(qv[(c, 0.5)]).cast("double").alias("median"),
                      F.lit(fences[c][1]).cast("double").alias("q3"),
                      F.col(f"{c}__max").alias("max"),
                      F.col(f"{c}__wlo").alias("whisker_low"), F.col(f"{c}__whi").alias("whisker_high"),
                      F.col(f"{c}__fl").cast("long").alias("n_fliers")) for c in cols]
    return stats.select(F.inline(F.array(*parts)))


# ---------------------------------------------------------------- A15
def histogram(df: DataFrame, cols: Sequence[str] | str, bins: int) -> DataFrame:
    """Equal-width histogram per column over [min, max], every bin present.

    bin = least(floor((x - min) * bins / (max - min)), bins - 1); a constant
    column uses [v - 0.5, v + 0.5] like numpy.  The bin spine comes from
    ``sequence`` so empty bins are kept (count 0).
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"))
                                        for c in cols]))).where(F.col("x").isNotNull())
    rng = long.groupBy("column").agg(F.min("x").alias("_mn"), F.max("x").alias("_mx"))
    rng = rng.select("column",
                     F.when(F.col("_mx") == F.col("_mn"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
                     F.when(F.col("_mx") == F.col("_mn"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"))
    b = F.least(F.floor((F.col("x") - F.col("_lo")) * F.lit(bins) / (F.col("_hi") - F.col("_lo"))),
                F.lit(bins - 1)).cast("int")
    # one row per column: bounded by the number of columns
    counts = (long.join(F.broadcast(rng), "column").select("column", b.alias("bin"))
                  .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count")))
    spine = rng.select("column", "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return (spine.join(counts, ["column", "bin"], "left")
                 .select("column", "bin",
                         (F.col("_lo") + F.col("bin") * width).alias("lower"),
                         (F.col("_lo") + (F.col("bin") + 1) * width).alias("upper"),
                         F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


# ---------------------------------------------------------------- A17, A18
def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair in one pass, long (col_a, col_b, corr).

    Nulls are dropped pairwise, like pandas; booleans are cast to int first.  A pair with
    fewer than two common rows or a constant column has no correlation (null)."""
    return correlations(df, {c: (F.col(f"`{c}`").cast("int") if isinstance(df.schema[c].dataType, T.BooleanType)
                                 else F.col(f"`{c}`")) for c in cols})


def correlation_all(df: DataFrame) -> DataFrame:
    """Correlation over every numeric and boolean column (A18), like
    ``pandas.DataFrame.corr(numeric_only=True)``."""
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
               T.DecimalType, T.BooleanType)
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, numeric)]
    return correlation(df, cols)


# ---------------------------------------------------------------- A20
def column_bytes(df: DataFrame) -> DataFrame:
    """Logical bytes per column (A20): width x non-null count, UTF-8 bytes for strings, 8 or
    16 bytes a decimal, width x elements for arrays of fixed width; null for other types."""
    aggs, parts = [], []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        element = f.dataType.elementType.simpleString() if isinstance(f.dataType, T.ArrayType) else None
        if t in FIXED_WIDTH:
            size = (F.count(c) * FIXED_WIDTH[t]).cast("long")
        elif isinstance(f.dataType, T.DecimalType):
            size = (F.count(c) * (8 if f.dataType.precision <= 18 else 16)).cast("long")
        elif t in ("string", "binary"):
            size = F.coalesce(F.sum(F.octet_length(c)), F.lit(0)).cast("long")
        elif element in FIXED_WIDTH:
            size = F.coalesce(F.sum(F.when(c.isNotNull(), F.size(c))), F.lit(0)).cast("long") * FIXED_WIDTH[element]
        else:
            size = F.max(F.lit(None).cast("long"))
        aggs.append(size.alias(f.name))
        parts.append(F.struct(F.lit(f.name).alias("column"), F.lit(t).alias("data_type"),
                              F.col(f"`{f.name}`").alias("bytes")))
    return df.agg(*aggs).select(F.inline(F.array(*parts)))


# ---------------------------------------------------------------- D4 - D7
def stack_tables(a: DataFrame, b: DataFrame) -> DataFrame:
    """Vertical concatenation by column name."""
    return a.unionByName(b)


def to_long(df: DataFrame, id_cols: Sequence[str], cols: Sequence[str],
            name: str = "feature", value: str = "value") -> DataFrame:
    """Columns to rows."""
    return df.unpivot(list(id_cols), list(cols), name, value)
