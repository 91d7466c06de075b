"""Magnitude spectra.

* ``spectrum_framed``: per key, consecutive frames of ``frame`` rows in order;
  a direct transform X_k = sum_j x_j e^(-2 pi i k j / n_f) as a generator
  (k = 0..n_f-1) plus one grouped sum, all JVM-side.  The last frame of a key
  may be shorter; its transform has its own length n_f.
* ``spectrum_global``: the FFT of a whole column in its global order, by the
  four-step algorithm: with N = N1 * N2, n = n1 + N1 n2 and k = k2 + N2 k1,
  FFTs of length N2 per n1 (one grouped pandas round), twiddles
  e^(-2 pi i n1 k2 / N), FFTs of length N1 per k2 (a second round).  Groups
  hold about sqrt(N) values.

Summaries: dominant frequency = argmax |X_k| over 1 <= k <= n/2 (first on
ties; the mirror half is skipped because |X_k| = |X_(n-k)|), spectral energy
sum |X_k|^2 and spectral entropy -sum p ln p with p = |X_k| / sum |X|.
"""
from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.order import _names, global_index, null_safe_join, total_rows


def _summaries(spec: DataFrame, keys: Sequence[str], n_col: str) -> DataFrame:
    """(keys, k, mag, n) -> dominant_k, spectral_energy, spectral_entropy."""
    half = F.floor(F.col(n_col) / 2)
    cand = F.when((F.col("k") >= 1) & (F.col("k") <= half), F.struct(F.col("mag"), -F.col("k")))
    mag = F.col("mag")
    # -sum p ln p with p = m / T is ln T - sum m ln m / T: one pass, no total beforehand
    weighted = F.sum(F.when(mag > 0, mag * F.log(mag)).otherwise(F.lit(0.0)))
    total = F.sum("mag")
    return spec.groupBy(*keys).agg(
        F.first(n_col).alias("n"), (-F.max(cand)["col2"]).cast("long").alias("dominant_k"),
        F.sum(mag * mag).alias("spectral_energy"),
        # below the rounding of the two logarithms there is one line only: no entropy
        F.when(F.log(total) - weighted / total > 1e-12, F.log(total) - weighted / total)
        .otherwise(F.lit(0.0)).alias("spectral_entropy"))


def spectrum_framed(df: DataFrame, col: str, order: Sequence[str], partition_by=None,
                    frame: int = 64, summary: bool = True) -> DataFrame:
    keys = _names(partition_by)
    indexed, sizes = global_index(df.select(*keys, *order, col), order, keys, rn="_rn")
    if keys:
        x = null_safe_join(indexed, sizes, keys)
    else:
        x = indexed.withColumn("n", F.lit(int(sizes.first()["n"])).cast("long"))
    x = x.select(*keys, F.floor(F.col("_rn") / frame).cast("long").alias("frame"),
                 (F.col("_rn") % frame).cast("long").alias("j"),
                 F.least(F.lit(frame).cast("long"), F.col("n") - F.floor(F.col("_rn") / frame) * frame)
                 .cast("long").alias("n_f"),
                 F.col(col).cast("double").alias("x"))
    ks = x.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_f") - 1)).alias("k"))
    ang = F.lit(2.0 * math.pi) * ((F.col("k") * F.col("j")) % F.col("n_f")) / F.col("n_f")
    spec = (ks.groupBy(*keys, "frame", "k")
              .agg(F.sum(F.col("x") * F.cos(ang)).alias("re"), (-F.sum(F.col("x") * F.sin(ang))).alias("im"),
                   F.first("n_f").alias("n_f"))
              .withColumn("mag", F.sqrt(F.col("re") ** 2 + F.col("im") ** 2)))
    if not summary:
        return spec
    return _summaries(spec, keys + ["frame"], "n_f")


def _factor(n: int) -> tuple[int, int]:
    """N = N1 * N2 with N1 <= N2 as close to sqrt(N) as possible."""
    best = 1
    for a in range(1, int(math.isqrt(n)) + 1):
        if n % a == 0:
            best = a
    return best, n // best


def fft_indexed(df: DataFrame, length: int, idx: str = "idx", re: str = "re", im: str = "im") -> DataFrame:
    """Distributed FFT of a complex sequence given as rows (idx, re, im).

    Four-step with length = N1 * N2: rows may be missing (they are zeros), so
    zero padding costs nothing.  Groups hold N2 (first round) and N1 (second
    round) values.  Returns (k, re, im) for every k in [0, length).
    """
    n1, n2 = _factor(length)
    x = df.select((F.col(idx) % n1).cast("long").alias("n1"), F.floor(F.col(idx) / n1).cast("long").alias("n2"),
                  F.col(re).cast("double").alias("re"), F.col(im).cast("double").alias("im"))

    def first_round(pdf: pd.DataFrame) -> pd.DataFrame:
        a = int(pdf["n1"].iloc[0])
        v = np.zeros(n2, dtype=np.complex128)
        v[pdf["n2"].to_numpy()] = pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy()
        y = np.fft.fft(v)
        k2 = np.arange(n2, dtype=np.int64)
        y = y * np.exp(-2j * np.pi * ((a * k2) % length) / length)
        return pd.DataFrame({"n1": a, "k2": k2, "re": y.real, "im": y.imag})

    y = x.groupBy("n1").applyInPandas(first_round, "n1 long, k2 long, re double, im double")

    def second_round(pdf: pd.DataFrame) -> pd.DataFrame:
        b = int(pdf["k2"].iloc[0])
        v = np.zeros(n1, dtype=np.complex128)
        v[pdf["n1"].to_numpy()] = pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy()
        z = np.fft.fft(v)
        return pd.DataFrame({"k": b + n2 * np.arange(n1, dtype=np.int64), "re": z.real, "im": z.imag})

    return y.groupBy("k2").applyInPandas(second_round, "k long, re double, im double")


def _balanced(n: int) -> bool:
    """Whether n = N1 * N2 with both within a factor of 16 of each other."""
    a, b = _factor(n)
    return b <= 16 * a


def _chirp(idx, n: int):
    """angle pi * (idx^2 mod 2n) / n, the square in whole decimals (exact for idx < 10^18)."""
    whole = F.col(idx).cast("decimal(19,0)")
    return F.lit(math.pi) * F.pmod(whole * whole, F.lit(2 * n).cast("decimal(20,0)")).cast("double") / F.lit(float(n))


def _bluestein(x: DataFrame, n: int) -> DataFrame:
    """Chirp-z transform of (idx, re) of length n via FFTs of a padded
    power-of-two length M >= 2n - 1:  X_k = w_k * IFFT(FFT(a) FFT(b))_k with
    a_j = x_j conj(w_j), b_m = w_m^-1 ... (w_j = e^{-i pi j^2 / n})."""
    spark = x.sparkSession
    m = 1 << int(math.ceil(math.log2(2 * n - 1)))
    ang = _chirp("idx", n)
    a = x.select("idx", (F.col("re") * F.cos(ang)).alias("re"), (-F.col("re") * F.sin(ang)).alias("im"))
    pos = spark.range(0, n).withColumnRenamed("id", "idx")
    neg = spark.range(1, n).select((F.lit(m) - F.col("id")).alias("idx"), F.col("id").alias("j"))
    b = pos.select("idx", F.cos(_chirp("idx", n)).alias("re"), F.sin(_chirp("idx", n)).alias("im")).unionByName(
        neg.select("idx", F.cos(_chirp("j", n)).alias("re"), F.sin(_chirp("j", n)).alias("im")))
    fa = fft_indexed(a, m).select("k", F.col("re").alias("ar"), F.col("im").alias("ai"))
    fb = fft_indexed(b, m).select("k", F.col("re").alias("br"), F.col("im").alias("bi"))
    # conj of the product, so a forward FFT gives M * conj(inverse FFT)
    prod = fa.join(fb, "k").select(F.col("k").alias("idx"),
                                   (F.col("ar") * F.col("br") - F.col("ai") * F.col("bi")).alias("re"),
                                   (-(F.col("ar") * F.col("bi") + F.col("ai") * F.col("br"))).alias("im"))
    c = fft_indexed(prod, m).where(F.col("k") < n).select(
        "k", (F.col("re") / m).alias("cr"), (-F.col("im") / m).alias("ci"))
    w = _chirp("k", n)
    return c.select("k", (F.col("cr") * F.cos(w) + F.col("ci") * F.sin(w)).alias("re"),
                    (F.col("ci") * F.cos(w) - F.col("cr") * F.sin(w)).alias("im"))


def spectrum_global(df: DataFrame, col: str, order: Sequence[str], summary: bool = True) -> DataFrame:
    """|FFT| of the whole ordered column; one row per k, or the summary row.

    A length without a balanced factor pair (e.g. a prime), which would leave a
    round with few groups, goes through the chirp-z transform on a padded
    power-of-two length instead; groups hold about sqrt(n) values at any length.
    """
    indexed, sizes = global_index(df.select(*order, col), order, None, rn="_rn")
    n = int(sizes.first()["n"])
    x = indexed.select(F.col("_rn").alias("idx"), F.coalesce(F.col(col).cast("double"), F.lit(0.0)).alias("re"),
                       F.lit(0.0).alias("im"))
    if _balanced(n):
        z = fft_indexed(x, n)
    else:
        z = _bluestein(x, n)
    spec = z.select("k", F.sqrt(F.col("re") ** 2 + F.col("im") ** 2).alias("mag"))
    if not summary:
        return spec
    return _summaries(spec.withColumn("column", F.lit(col)).withColumn("_n", F.lit(n).cast("long")),
                      ["column"], "_n")


def spectrum_at(df: DataFrame, col: str, order: Sequence[str], ks: Sequence[int]) -> DataFrame:
    """(k, re, im, mag) of chosen bins of the whole ordered column, without a transform.

    Every row adds x e^(-2 pi i k j / n) to each bin, with k j reduced modulo n in whole
    numbers, so phases are exact at any length; sums are combined before the exchange.
    It answers questions on single bins and checks ``spectrum_global`` at any size."""
    indexed, sizes = global_index(df.select(*order, col), order, None, rn="_rn")
    n = total_rows(sizes)
    x, ks = F.coalesce(F.col(col).cast("double"), F.lit(0.0)), sorted({int(k) for k in ks if 0 <= k < max(n, 1)})

    def angle(k):
        whole = "long" if k * n < 1 << 62 else "decimal(19,0)"
        return F.lit(2.0 * math.pi / n) * ((F.lit(k).cast(whole) * F.col("_rn")) % F.lit(n)).cast("double")

    if not ks or n == 0:
        return df.sparkSession.createDataFrame([], "k long, re double, im double, mag double")
    sums = [F.sum(x * f(angle(k))).alias(f"{name}{k}") for k in ks for name, f in (("c", F.cos), ("s", F.sin))]
    parts = [F.struct(F.lit(k).cast("long").alias("k"), F.col(f"c{k}").alias("re"), (-F.col(f"s{k}")).alias("im"),
                      F.hypot(f"c{k}", f"s{k}").alias("mag")) for k in ks]
    return indexed.agg(*sums).select(F.inline(F.array(*parts)))
