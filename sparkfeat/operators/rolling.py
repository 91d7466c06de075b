"""Windows over one ordered series.

The series order is global (the reference sorts the whole table by ``ts``)
or per key with ``partition_by``.  Either way rows are numbered with the
range-partitioned global index and cut into bounded chunks with a halo of
``w - 1`` rows (``plans.order``), so no task ever holds more than one chunk,
even when one key owns a third of the table.

* ``rolling``: mean / var / sum / std / min / max over the last ``w`` rows;
  ``min_periods`` non-null rows are required (pandas default: ``w``).  All
  windows share one shuffle and one sort.
* ``ema``: exponentially weighted mean with span ``w``, adjusted weights
  (pandas ``ewm(span=w).mean()``), by a chunk scan with carries.
* ``sign_changes``: sign of ``x - mean`` differs from the previous row's.
"""
from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.order import (_names, choose_chunk, decay_scan, global_index, null_safe_join, total_rows,
                           with_halo)

_FNS = {"mean": ("MA", F.avg), "var": ("VAR", F.var_samp), "sum": ("SUM", F.sum),
        "std": ("STD", F.stddev_samp), "min": ("MIN", F.min), "max": ("MAX", F.max)}


def _parallelism(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def rolling(df: DataFrame, cols: Sequence[str], order: Sequence[str], windows: Sequence[int],
            fns: Sequence[str] = ("mean",), min_periods: int | None = None, partition_by=None,
            name: str = "{col}_{fn}_{w}", chunk: int | None = None, keep_index: bool = False) -> DataFrame:
    """Row-frame aggregates over the last ``w`` rows in ``order``."""
    keys = _names(partition_by)
    windows = list(windows)
    wmax = max(windows)
    indexed, sizes = global_index(df, order, keys, rn="_rn")
    n = total_rows(sizes)
    C = chunk or choose_chunk(n, wmax - 1, _parallelism(df))
    framed = with_halo(indexed, "_rn", C, wmax - 1)
    part = keys + ["_chunk"]
    new = {}
    for w in windows:
        spec = Window.partitionBy(*part).orderBy("_rn").rowsBetween(-(w - 1), 0)
        need = w if min_periods is None else min_periods
        for c in cols:
            cnt = F.count(c).over(spec)
            for fn in fns:
                label, agg = _FNS[fn]
                new[name.format(col=c, fn=label, w=w)] = F.when(cnt >= need, agg(F.col(c)).over(spec))
    out = framed.withColumns(new).where(F.col("_home")).drop("_chunk", "_home")
    return out if keep_index else out.drop("_rn")


def ema(df: DataFrame, cols: Sequence[str], order: Sequence[str], spans: Sequence[int],
        partition_by=None, name: str = "{col}_EMA_{w}", chunk: int | None = None,
        keep_index: bool = False) -> DataFrame:
    """Exponential mean, alpha = 2/(span+1), adjusted weights.

    y_t = sum_i q^(t-i) x_i / sum_i q^(t-i) over non-null x_i, q = 1 - alpha;
    a null keeps decaying (the output repeats the last value), as pandas does.
    A chunk's state is the numerator and denominator at its last non-null row,
    so the denominator is at least 1 however long a null run is; the carry into
    a chunk is the state at the last non-null row before it, summed from the
    states of the chunks that hold values (weights below 2^-80 of the newest,
    which is 1, vanish in double precision).  Only the ratio passes a null run.
    """
    keys = _names(partition_by)
    spans = list(spans)
    indexed, sizes = global_index(df, order, keys, rn="_rn")
    n = total_rows(sizes)
    C = chunk or choose_chunk(n, 0, _parallelism(df))
    d = indexed.withColumn("_chunk", F.floor(F.col("_rn") / F.lit(C)).cast("long"))
    qs = {w: 1.0 - 2.0 / (w + 1.0) for w in spans}
    inside = Window.partitionBy(*keys, "_chunk")
    value = {c: F.col(c).cast("double") for c in cols}
    seen = {c: value[c].isNotNull() & ~F.isnan(value[c]) for c in cols}
    marked = d.withColumns({f"T__{c}": F.max(F.when(seen[c], F.col("_rn"))).over(inside) for c in cols})
    aggs = [F.first(f"T__{c}").alias(f"T__{c}") for c in cols]
    for w in spans:
        for c in cols:
            wt = F.pow(F.lit(qs[w]), (F.col(f"T__{c}") - F.col("_rn")).cast("double"))
            aggs.append(F.sum(F.when(seen[c], value[c] * wt)).alias(f"S__{c}__{w}"))
            aggs.append(F.sum(F.when(seen[c], wt)).alias(f"D__{c}__{w}"))
    states = marked.groupBy(*keys, "_chunk").agg(*aggs)
    # a chunk further back weighs q^C less; two chunks' last values may be one row apart
    lookback = 2 + max(math.ceil(80 * math.log(2) / (-C * math.log(qs[w]))) if qs[w] > 0 else 0 for w in spans)
    carry_tbl = states
    for c in cols:
        # windows over the chunk table (one row per chunk), per key, chunks with values only
        held = Window.partitionBy(*keys, F.col(f"T__{c}").isNotNull()).orderBy("_chunk").rowsBetween(-lookback, 0)
        before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        for w in spans:
            for kind in ("S", "D"):
                nm = f"{kind}__{c}__{w}"
                past = F.collect_list(F.struct(F.col(f"T__{c}").alias("t"), F.col(nm).alias("v"))).over(held)
                carry_tbl = carry_tbl.withColumn(f"_past_{nm}", F.when(
                    F.col(f"T__{c}").isNotNull(), F.aggregate(past, F.lit(0.0), _carry_step(f"T__{c}", qs[w]))))
        carry_tbl = carry_tbl.withColumns(
            {f"CT__{c}": F.last(f"T__{c}", True).over(before)}
            | {f"C{k}__{c}__{w}": F.last(f"_past_{k}__{c}__{w}", True).over(before) for w in spans for k in "SD"})
    # renamed keys: the carry table comes from the same lineage as the rows
    carry_tbl = carry_tbl.select(*[F.col(k).alias(f"_ck_{i}") for i, k in enumerate(keys)],
                                 F.col("_chunk").alias("_ck_chunk"), *[f"CT__{c}" for c in cols],
                                 *[f"C{k}__{c}__{w}" for w in spans for c in cols for k in "SD"])

    out_fields = list(d.schema.fields) + [T.StructField(name.format(col=c, w=w), T.DoubleType(), True)
                                          for w in spans for c in cols]
    out_schema = T.StructType(out_fields)
    col_order = [f.name for f in out_fields]

    def scan(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return pd.DataFrame({c: [] for c in col_order})
        left = left.sort_values("_rn", kind="stable").reset_index(drop=True)
        start = int(left["_chunk"].iloc[0]) * C
        pos = left["_rn"].to_numpy(dtype=np.int64) - start
        carry = None if right.empty else right.iloc[0]
        for c in cols:
            x = left[c].to_numpy(dtype=np.float64, na_value=np.nan)
            ok = ~np.isnan(x)
            last = None if carry is None or pd.isna(carry[f"CT__{c}"]) else int(carry[f"CT__{c}"]) - start
            # the newest value at or before each row: -1 is the carry
            newest = np.maximum.accumulate(np.where(ok, np.arange(len(x)), -1))
            for w in spans:
                q = qs[w]
                num = decay_scan(np.where(ok, x, 0.0), q)
                den = decay_scan(ok.astype(np.float64), q)
                before = np.nan
                if last is not None:
                    decay = np.power(q, (pos - last).astype(np.float64))
                    s0, d0 = float(carry[f"CS__{c}__{w}"]), float(carry[f"CD__{c}__{w}"])
                    num, den, before = num + s0 * decay, den + d0 * decay, s0 / d0
                y = np.full(len(x), np.nan)
                y[ok] = num[ok] / den[ok]
                left[name.format(col=c, w=w)] = np.where(newest >= 0, y[newest], before)
        return left[col_order]

    res = (d.groupBy(*keys, "_chunk")
             .cogroup(carry_tbl.groupBy(*[f"_ck_{i}" for i in range(len(keys))], "_ck_chunk"))
             .applyInPandas(scan, out_schema)).drop("_chunk")
    return res if keep_index else res.drop("_rn")


def _carry_step(at: str, q: float):
    def step(acc, s):
        return acc + s["v"] * F.pow(F.lit(q), (F.col(at) - s["t"]).cast("double"))
    return step


def sign_changes(df: DataFrame, cols: Sequence[str] | str, order: Sequence[str], partition_by=None,
                 name: str = "{col}_sign_change", chunk: int | None = None, keep_index: bool = False) -> DataFrame:
    """True where sign(x - mean) differs from the previous row's (0 is its own sign).

    The first row of the series is False.  The mean is over the whole series
    (per key with ``partition_by``).
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    keys = _names(partition_by)
    means = df.groupBy(*keys).agg(*[F.avg(F.col(c).cast("double")).alias(f"_m__{c}") for c in cols])
    if keys:
        base = null_safe_join(df, means, keys)
    else:
        m = means.first()  # one row: the series mean of each column
        base = df.withColumns({f"_m__{c}": F.lit(m[f"_m__{c}"]).cast("double") for c in cols})
    base = base.withColumns({f"_s__{c}": F.signum(F.col(c).cast("double") - F.col(f"_m__{c}")) for c in cols})
    indexed, sizes = global_index(base, order, keys, rn="_rn")
    n = total_rows(sizes)
    C = chunk or choose_chunk(n, 1, _parallelism(df))
    framed = with_halo(indexed, "_rn", C, 1)
    spec = Window.partitionBy(*keys, "_chunk").orderBy("_rn")
    new = {name.format(col=c): F.coalesce(F.lag(f"_s__{c}").over(spec) != F.col(f"_s__{c}"), F.lit(False))
           for c in cols}
    out = (framed.withColumns(new).where(F.col("_home"))
                 .drop("_chunk", "_home", *[f"_m__{c}" for c in cols], *[f"_s__{c}" for c in cols]))
    return out if keep_index else out.drop("_rn")
