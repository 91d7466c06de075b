"""Exact order statistics by narrowing brackets, without a sketch or sort in one task.

Every wanted rank has an open bracket (lo, hi) - at first the whole column - and its
rank among the values strictly inside.  A round takes two scans for all of them:

1. a random sample of at most ``ACCURACY`` values from inside each bracket gives two
   splitters around the wanted rank, a few standard errors apart;
2. one aggregation counts, for each rank, the values inside the bracket below the
   first splitter, equal to it, between the two and equal to the second.

The counts are exact, so the rank is either one of the splitters or lies in one of the
three smaller brackets, wherever the sample put them: a poor sample costs a round, never
the result.  A bracket with at most ``ACCURACY`` values is read whole.  Each round leaves
about 1 / 80 of a bracket (n = 1e12: four rounds).  A value that repeats a third of the
table is recognised by its count.  The driver holds samples and counts of bounded size;
no task merges or sorts more than its own rows.
"""
from __future__ import annotations

import math
from typing import Dict, Sequence, Tuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCURACY = 50_000  # values sampled from an open bracket; one with fewer is read whole


def quantile_values(df: DataFrame, cols: Sequence[str], qs: Sequence[float],
                    method: str = "linear", accuracy: int = ACCURACY) -> Dict[Tuple[str, float], float]:
    """Exact quantiles per column, on the wide table (no reshaping, no joins).

    ``linear``: v[floor(p)] + (v[ceil(p)] - v[floor(p)]) * (p - floor(p)), p = (n-1)q
    (numpy / pandas default, DuckDB ``quantile_cont``, Spark ``percentile``).
    ``nearest``: v[round_half_even((n-1)q)].  Nulls are dropped.

    ``accuracy``: values sampled per open bracket (see the module's text).
    """
    cols = list(cols)
    x = {c: F.col(c).cast("double") for c in cols}
    cnt = df.agg(*[F.count(x[c]).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    n = {c: int(cnt[f"n{i}"]) for i, c in enumerate(cols)}
    plan, ranks = {}, {c: set() for c in cols}
    for c in cols:
        for q in qs:
            if n[c] == 0:
                plan[(c, q)] = None
                continue
            pos = (n[c] - 1) * q
            if method == "linear":
                lo = int(pos // 1)
                hi = min(lo + 1, n[c] - 1) if pos > lo else lo
                plan[(c, q)] = ("lin", lo, hi, pos - lo)
                ranks[c].update({lo, hi})
            elif method == "nearest":
                k = int(round(pos))  # Python round is half-to-even
                plan[(c, q)] = ("near", k)
                ranks[c].add(k)
            else:
                raise ValueError(method)
    vals = wide_select(df, {c: sorted(r) for c, r in ranks.items() if r}, n, accuracy)
    out = {}
    for (c, q), p in plan.items():
        if p is None:
            out[(c, q)] = None
        elif p[0] == "near":
            out[(c, q)] = vals[(c, p[1])]
        else:
            a, b = vals[(c, p[1])], vals[(c, p[2])]
            out[(c, q)] = a if p[1] == p[2] else a + (b - a) * p[3]
    return out


def wide_select(df: DataFrame, ranks: Dict[str, Sequence[int]], n: Dict[str, int],
                accuracy: int = ACCURACY) -> Dict[Tuple[str, int], float]:
    """Exact value at 0-based rank r of each column (ascending, nulls dropped, NaN last)."""
    found: Dict[Tuple[str, int], float] = {}
    # (column, rank) -> (lo, hi, rank inside, values inside); None: no bound
    todo = {(c, r): (None, None, r, n[c]) for c, rs in ranks.items() for r in rs}
    seed = 0
    while todo:
        seed += 1
        samples = _samples(df, {(c, lo, hi): m for (c, _), (lo, hi, _, m) in todo.items()}, accuracy, seed)
        asks = {}
        for (c, r), (lo, hi, k, m) in list(todo.items()):
            s = samples.get((c, lo, hi), np.empty(0))
            if m <= accuracy:
                found[(c, r)] = float(s[k])
                del todo[(c, r)]
                continue
            at, spread = k / m * len(s), 2.0 * math.sqrt(len(s)) + 2.0
            i, j = int(at - spread), int(at + spread) + 1
            if i < 0 and j >= len(s) > 0:
                i = j = len(s) // 2  # a sample too small for a bracket halves the values
            asks[(c, r)] = (float(s[i]) if 0 <= i < len(s) else None, float(s[j]) if 0 <= j < len(s) else None)
        for key, counts in _counts(df, {k: (*todo[k][:2], *v) for k, v in asks.items()}).items():
            lo, hi, k, m = todo[key]
            a, b = asks[key]
            at = [lo, lo if a is None else a, hi if b is None else b, hi]
            for part, size in enumerate(counts):  # below a, equal to a, between, equal to b, above b
                if k < size:
                    break
                k -= size
            if part in (1, 3):
                found[key] = a if part == 1 else b
                del todo[key]
            else:
                todo[key] = (at[part // 2], at[part // 2 + 1], k, size)
    return found


def _inside(v, lo, hi):
    ok = v.isNotNull()
    if lo is not None:
        ok &= v > F.lit(lo)
    if hi is not None:
        ok &= v < F.lit(hi)
    return ok


def _samples(df: DataFrame, brackets: Dict[tuple, int], most: int, seed: int) -> Dict[tuple, np.ndarray]:
    """Sorted values from inside each bracket: all, or about ``most`` at random."""
    names, picks = list(brackets), []
    for t, (c, lo, hi) in enumerate(names):
        v = F.col(c).cast("double")
        take = _inside(v, lo, hi)
        if brackets[names[t]] > most:
            take &= F.rand(seed * 1_009 + t) < F.lit(most / brackets[names[t]])
        picks.append(F.when(take, F.struct(F.lit(t).alias("t"), v.alias("v"))))
    rows = (df.select(F.array(*picks).alias("p")).select(F.explode("p").alias("p")).where("p is not null")
            .select("p.t", "p.v").toPandas())
    value, own = rows["v"].to_numpy(np.float64), rows["t"].to_numpy()
    return {name: np.sort(value[own == t]) for t, name in enumerate(names)}


def _counts(df: DataFrame, asks: Dict[tuple, tuple]) -> Dict[tuple, list]:
    """Per ask (lo, hi, a, b): values inside (lo, hi) below a, equal to a, between a and b,
    equal to b, above b.  A missing splitter has nothing on its far side."""
    if not asks:
        return {}
    aggs, keys = [], list(asks)
    for t, key in enumerate(keys):
        lo, hi, a, b = asks[key]
        v = F.col(key[0]).cast("double")
        ok = _inside(v, lo, hi)
        no = F.lit(False)
        one = a is not None and a == b  # both splitters are one value: nothing between
        parts = [no if a is None else v < F.lit(a), no if a is None else v == F.lit(a),
                 no if one else (F.lit(True) if a is None else v > F.lit(a)) & (F.lit(True) if b is None else v < F.lit(b)),
                 no if b is None or one else v == F.lit(b), no if b is None else v > F.lit(b)]
        aggs += [F.count_if(ok & p).alias(f"c{t}_{i}") for i, p in enumerate(parts)]
    row = df.agg(*aggs).first()
    return {key: [int(row[f"c{t}_{i}"]) for i in range(5)] for t, key in enumerate(keys)}
