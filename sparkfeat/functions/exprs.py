"""Small column-expression builders shared by the operators.

They are built from ``pyspark.sql.functions`` and stay inside whole-stage codegen, but
for ``sig_columns``, which rounds results for comparison in an Arrow-batched UDF.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIG_DIGITS = 9


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sig(c, digits: int = SIG_DIGITS) -> Column:
    """Round to ``digits`` significant digits, in two stages (digits + 3, then
    digits) so that values that are exactly on a rounding boundary (data
    with few decimals) but carry last-bit noise round the same way."""
    return _sig1(_sig1(c, digits + 3), digits)


def sig_columns(df, cols, digits: int = SIG_DIGITS):
    """``sig`` on whole columns, vectorised.

    Many columns of the nested CASE form make one fused codegen method too
    large for the JIT; here numpy rounds Arrow batches with exactly the same
    arithmetic (x * 10^s or x / 10^-s, ties away from zero, two stages).
    """
    cols = list(cols)
    if not cols:
        return df
    f = _sig_udf(digits)
    return df.withColumns({c: f(F.col(c).cast("double")) for c in cols})


def _np_sig1(x, digits: int):
    import numpy as np
    out = x.copy()
    ok = np.isfinite(x) & (x != 0)
    v = x[ok]
    s = (digits - 1) - np.floor(np.log10(np.abs(v)))
    p = np.power(10.0, np.abs(s))
    y = np.where(s >= 0, v * p, v / p)
    fl = np.floor(y)
    r = np.where(y - fl == 0.5, np.where(y > 0, np.ceil(y), fl), np.rint(y))
    out[ok] = np.where(s >= 0, r / p, r * p)
    out[x == 0] = 0.0
    return out


def _sig_udf(digits: int):
    import pandas as pd

    def rounded(s):
        x = s.to_numpy(dtype="float64", na_value=float("nan"))
        y = _np_sig1(_np_sig1(x, digits + 3), digits)
        return pd.Series(y, index=s.index).where(~s.isna(), None)

    # real classes (this module uses postponed annotations)
    rounded.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(rounded, "double")


def _sig1(c, digits: int) -> Column:
    """Round a double to ``digits`` significant digits (half away from zero).

    Used on outputs that are compared across engines: sums in a different
    order differ in the last bits, the rounded values do not.  Integral powers
    of ten are exact doubles, so the same arithmetic gives the same result in
    Spark and in any IEEE engine.  ``-0.0`` becomes ``0.0``.
    """
    x = col(c).cast("double")
    e = F.floor(F.log10(F.abs(x)))
    s = F.lit(digits - 1) - e
    up = F.round(x * F.pow(F.lit(10.0), s)) / F.pow(F.lit(10.0), s)
    down = F.round(x / F.pow(F.lit(10.0), -s)) * F.pow(F.lit(10.0), -s)
    return (
        F.when(x.isNull(), F.lit(None).cast("double"))
        .when(F.isnan(x), x)
        .when(x == 0, F.lit(0.0))
        .when(x.isin(float("inf"), float("-inf")), x)
        .when(s >= 0, up)
        .otherwise(down)
    )


def sig_sql(x: str, digits: int = SIG_DIGITS) -> str:
    """The same rounding as DuckDB SQL text.

    The value is bound once through a one-element list lambda, so the
    expression ``x`` is not repeated inside the CASE.
    """
    inner = f"list_transform([CAST(({x}) AS DOUBLE)], lambda v: {_sig1_sql('v', digits + 3)})[1]"
    return f"list_transform([{inner}], lambda w: {_sig1_sql('w', digits)})[1]"


def _sig1_sql(x: str, digits: int) -> str:
    e = f"floor(log10(abs({x})))"
    s = f"({digits - 1} - {e})"
    return (
        f"(CASE WHEN ({x}) IS NULL THEN NULL WHEN isnan({x}) THEN ({x}) "
        f"WHEN ({x}) = 0 THEN 0.0 "
        f"WHEN {s} >= 0 THEN round(({x}) * power(10.0, {s})) / power(10.0, {s}) "
        f"ELSE round(({x}) / power(10.0, -{s})) * power(10.0, -{s}) END)"
    )


def argmax_array(a) -> Column:
    """0-based index of the first maximum of an array (first on ties)."""
    a = col(a)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def clamp(c, lo, hi) -> Column:
    return F.least(F.greatest(col(c), F.lit(lo)), F.lit(hi))


def half_round(c) -> Column:
    """Round a double to the nearest IEEE half-precision value (as a double).

    q = 2^(max(floor(log2|x|), -14) - 10) is the spacing of half values around
    x (subnormals below 2^-14); rint(x/q)*q rounds half to even like numpy's
    float16 cast.  Magnitudes that round above 65504 become +-inf.
    """
    x = col(c).cast("double")
    ex = F.greatest(F.floor(F.log2(F.abs(x))), F.lit(-14))
    q = F.pow(F.lit(2.0), ex - 10)
    r = F.rint(x / q) * q
    return (
        F.when(x.isNull(), F.lit(None).cast("double"))
        .when(x == 0, x)
        .when(F.abs(r) > 65504.0, F.when(x > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf"))))
        .otherwise(r)
    )
