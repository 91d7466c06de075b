"""Compression of vectors, feature columns and weight tables.

The arithmetic of weight-only int8, float16, calibrated full int8 and
magnitude pruning, applied to whole tables: array columns are handled with
``transform`` lambdas (JVM-side, no UDF), scalar columns with one projection.
Calibration parameters are bounded metadata (two numbers per column).
"""
from __future__ import annotations

from typing import Dict, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import clamp, half_round
from ..plans.order import _names, global_index, null_safe_join
from .group_select import first_rows, group_sizes


# ------------------------------------------------------------------ C1
def quantize_vectors(df: DataFrame, col: str, codes: str = "codes", scale: str = "scale") -> DataFrame:
    """Symmetric per-vector int8: s = max|x| / 127, code = clamp(rint(x / s), -127, 127)."""
    s = F.array_max(F.transform(F.col(col), lambda x: F.abs(x.cast("double")))) / F.lit(127.0)
    out = df.withColumn(scale, s)
    q = F.transform(F.col(col), lambda x: F.when(F.col(scale) == 0, F.lit(0))
                    .otherwise(clamp(F.rint(x.cast("double") / F.col(scale)), -127, 127)).cast("tinyint"))
    return out.withColumn(codes, q)


def dequantize_vectors(df: DataFrame, codes: str = "codes", scale: str = "scale", out: str = "restored") -> DataFrame:
    return df.withColumn(out, F.transform(F.col(codes), lambda c: c.cast("double") * F.col(scale)))


# ------------------------------------------------------------------ C2
def half(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Round to IEEE half precision (kept as double); arrays element-wise."""
    out = out or col
    dt = df.schema[col].dataType.simpleString()
    if dt.startswith("array"):
        return df.withColumn(out, F.transform(F.col(col), lambda x: half_round(x)))
    return df.withColumn(out, half_round(col))


# ------------------------------------------------------------------ C3 - C5
def calibrate(df: DataFrame, cols: Sequence[str]) -> Dict[str, tuple]:
    """Affine int8 parameters per column from a representative table.

    The range always includes 0; scale = (max - min) / 255 and
    zero point = rint(-128 - min / scale).  A zero scale is an error.
    """
    r = df.agg(*[F.min(F.col(c).cast("double")).alias(f"mn_{i}") for i, c in enumerate(cols)],
               *[F.max(F.col(c).cast("double")).alias(f"mx_{i}") for i, c in enumerate(cols)]).first()
    params = {}
    for i, c in enumerate(cols):
        if r[f"mn_{i}"] is None:
            raise ValueError(f"column {c}: no value to calibrate on")
        mn, mx = min(r[f"mn_{i}"], 0.0), max(r[f"mx_{i}"], 0.0)
        scale = (mx - mn) / 255.0
        if scale == 0:
            raise ValueError(f"column {c}: zero quantization scale")
        zp = float(_rint(-128.0 - mn / scale))
        params[c] = (scale, zp)
    return params


def _rint(x: float) -> float:
    """Round half to even, like numpy.round and Spark rint."""
    return float(round(x))


def quantize(df: DataFrame, params: Dict[str, tuple], suffix: str = "") -> DataFrame:
    """code = clamp(rint(x / scale + zp), -128, 127) as tinyint (C4)."""
    out = {}
    for c, (scale, zp) in params.items():
        if scale == 0:
            out[c + suffix] = F.raise_error(F.lit(f"zero quantization scale for {c}"))
            continue
        out[c + suffix] = clamp(F.rint(F.col(c).cast("double") / F.lit(scale) + F.lit(zp)), -128, 127).cast("tinyint")
    return df.withColumns(out)


def dequantize(df: DataFrame, params: Dict[str, tuple], suffix: str = "") -> DataFrame:
    """x' = (code - zp) * scale."""
    return df.withColumns({c + suffix: (F.col(c + suffix if suffix else c).cast("double") - F.lit(zp)) * F.lit(scale)
                           for c, (scale, zp) in params.items()})


def quantization_error(df: DataFrame, params: Dict[str, tuple]) -> DataFrame:
    """Per column: scale, zero point, max |dequantize(quantize(x)) - x|, and whether
    that stays within scale / 2 (true inside the calibrated range)."""
    q = dequantize(quantize(df, params, "__q"), params, "__q")
    stats = q.agg(*[F.max(F.abs(F.col(c + "__q") - F.col(c).cast("double"))).alias(c) for c in params])
    parts = [F.struct(F.lit(c).alias("column"), F.lit(s).alias("scale"), F.lit(z).alias("zero_point"),
                      F.col(c).alias("max_abs_error"),
                      (F.col(c) <= F.lit(s / 2.0 * (1 + 1e-9))).alias("within_bound")) for c, (s, z) in params.items()]
    return stats.select(F.inline(F.array(*parts)))


# ------------------------------------------------------------------ C6 - C8
def prune(df: DataFrame, value: str, group=None, sparsity: float = 0.7, tie=None,
          out: str | None = None) -> DataFrame:
    """Zero the n - round(n (1 - s)) smallest |w| per group.

    One cut value a group is found without sorting or shuffling a weight.  Equal
    weights are cut in the order of ``tie``, else of a hash of the whole row, so
    reruns agree; rows without a group are one group.
    """
    out = out or value
    keys = _names(group)
    order = [F.abs(F.col(value).cast("double")), *([F.col(c) for c in _names(tie)] or [F.xxhash64(*df.columns)])]
    wanted = group_sizes(df, keys).withColumn("take", (F.col("n") - F.bround(F.col("n") * F.lit(1.0 - sparsity))).cast("long"))
    marked = first_rows(df, keys, order, wanted, "_cut")
    return marked.withColumn(out, F.when(F.col("_cut"), F.lit(0.0)).otherwise(F.col(value).cast("double"))).drop("_cut")


def sparsity(df: DataFrame, value: str, group=None) -> DataFrame:
    """Zeros / total in percent, per group."""
    keys = _names(group)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                 F.count_if(F.col(value) == 0).alias("n_zero"),
                                 (100.0 * F.avg((F.col(value) == 0).cast("double"))).alias("sparsity_pct"))


def sparsity_schedule(spark: SparkSession, n_train: int, batch: int = 8, epochs: int = 10, initial: float = 0.0,
                      final: float = 0.7, every: int = 100, power: int = 3) -> DataFrame:
    """(step, target_sparsity) of the polynomial ramp (C7): end step T = ceil(n/batch) * epochs,
    s(t) = final + (initial - final) (1 - t/T)^power at t = 0, every, 2*every, ... <= T."""
    end = -(-n_train // batch) * epochs
    left = F.pow(F.lit(1.0) - F.col("id") / F.lit(float(end)), F.lit(float(power))) if end else F.lit(1.0)
    return spark.range(0, end + 1, every).select(F.col("id").cast("int").alias("step"),
                                                 (F.lit(final) + F.lit(initial - final) * left).alias("target_sparsity"))


RANK_BLOCK = 1_024  # ranks whose counts are summed before levels look at single weights


def sparsity_sweep(df: DataFrame, value: str, group, levels: DataFrame | Sequence[float], tie=None) -> DataFrame:
    """Achieved sparsity of every (group, level) (C7): the weights that are pruned, by their
    rank, or zero already.  ``levels`` is a table with ``target_sparsity`` or a list of them.

    Weights are ranked by the global index.  Zeros are summed by blocks of ranks; a level
    takes the sums of the blocks below its cut and looks at the weights of the cut's block."""
    keys, spark = _names(group), df.sparkSession
    if not isinstance(levels, DataFrame):
        levels = spark.createDataFrame([(float(s),) for s in levels], "target_sparsity double")
    weight = F.col(value).cast("double")
    order = {"_none": F.isnull(weight), "_abs": F.abs(weight), **({} if tie else {"_tie": F.xxhash64(*df.columns)})}
    d = df.withColumns(order).withColumn("_zero", F.coalesce(weight == 0, F.lit(False)).cast("long"))
    ranked, _ = global_index(d.select(*dict.fromkeys([*keys, *_names(tie), *order, "_zero"])),
                                 [*order, *_names(tie)], keys, rn="_rn")
    ranked = ranked.withColumn("_block", F.floor(F.col("_rn") / F.lit(RANK_BLOCK)).cast("long"))
    blocks = ranked.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_rows"), F.sum("_zero").alias("_zeros"))
    below = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns({c: F.coalesce(F.sum(c[:-1]).over(below), F.lit(0)) for c in ("_rows_", "_zeros_")})
    total = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("_zero").alias("_all"))
    wanted = total.crossJoin(levels).withColumn(
        "_cut", (F.col("n") - F.bround(F.col("n") * (F.lit(1.0) - F.col("target_sparsity")))).cast("long"))
    # a cut behind the last rank looks into the last block
    wanted = wanted.withColumn("_block", F.floor(F.least(F.col("_cut"), F.col("n") - 1) / F.lit(RANK_BLOCK)).cast("long"))
    known = null_safe_join(wanted, blocks.drop("_rows", "_zeros"), [*keys, "_block"])
    cuts = known.select(*keys, "_block", "_cut").distinct()
    inside = (null_safe_join(ranked.select(*keys, "_block", "_rn", "_zero"), cuts, [*keys, "_block"])
              .where(F.col("_rn") < F.col("_cut")).groupBy(*keys, "_cut")
              .agg(F.count(F.lit(1)).alias("_rows"), F.sum("_zero").alias("_zeros")))
    on = F.lit(True)
    for i, k in enumerate([*keys, "_cut"]):
        inside = inside.withColumnRenamed(k, f"_in_{i}")
        on = on & F.col(k).eqNullSafe(F.col(f"_in_{i}"))
    got = lambda c: F.coalesce(F.col(c), F.lit(0)) + F.col(f"{c}_")
    n_zero = (got("_rows") + F.col("_all") - got("_zeros")).cast("long")
    steps = [c for c in levels.columns if c != "target_sparsity"]
    return (known.join(inside, on, "left").withColumn("n_zero", n_zero)
                 .select(*keys, "n", *steps, "target_sparsity", "n_zero")
                 .withColumn("achieved_pct", 100.0 * F.col("n_zero") / F.col("n")))
