"""The first rows of every group, by one cut value a group instead of a rank a row.

``first_rows`` flags, in each group, the ``take`` smallest rows in a given order.  It keeps
one open bracket a group in a table, and narrows all of them at once.  A round reads
the keys and order columns twice:

1. a sample from inside each open bracket (bounded a group) gives two splitters around
   the wanted rank;
2. one aggregation by group counts the rows below, at, between, at and above them.

The counts are exact, so the cut is a splitter or in a smaller bracket; a bracket of few
rows is read whole.  No row is sorted or shuffled: groups meet the scan by broadcast (up to
``BROADCAST_GROUPS`` of them, a row of a few numbers each; beyond, in a join of the
projected columns) and counts are combined before the exchange, so a hot group costs a row
a task.  Only where the cut falls among rows that are equal in the whole order are those
rows (and no others) dealt out to be told apart.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.order import global_index
from ..session import materialize

BROADCAST_GROUPS = 200_000
SAMPLES, LEAST, MOST = 2_000_000, 256, 50_000  # sampled rows: over all groups, and of one group


def _with_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str], n_groups: int) -> DataFrame:
    """Inner join on ``keys`` in which a null key meets a null key."""
    side = groups.withColumnsRenamed({k: f"_key_{i}" for i, k in enumerate(keys)})
    if n_groups <= BROADCAST_GROUPS:
        side = F.broadcast(side)
    if not keys:
        return df.crossJoin(side)  # one row
    on = [F.col(f"`{k}`").eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    return df.join(side, on).drop(*[f"_key_{i}" for i in range(len(keys))])


def _cuts(slim: DataFrame, keys: list[str], wanted: DataFrame, most: int) -> DataFrame:
    """(keys, cut, below, equal, take) of the groups in ``wanted`` (keys, n, take), 0 < take < n."""
    o = F.col("_o")
    kind = slim.schema["_o"].dataType
    none = F.lit(None).cast(kind)
    todo = materialize(wanted.select(*keys, "take", none.alias("lo"), none.alias("hi"), F.col("take").alias("k"),
                                     F.col("n").alias("m"), F.lit(0).cast("long").alias("base")), "cut-brackets")
    found, turn = None, 0
    while True:
        n_groups = todo.count()
        if n_groups == 0 and found is not None:
            return found
        turn += 1
        size = max(LEAST, min(most, SAMPLES // max(n_groups, 1)))
        inside = (F.col("lo").isNull() | (o > F.col("lo"))) & (F.col("hi").isNull() | (o < F.col("hi")))
        rows = _with_groups(slim, todo, keys, n_groups).where(inside)
        some = rows.where((F.col("m") <= size) | (F.rand(turn) < F.lit(float(size)) / F.col("m")))
        some = some.groupBy(*keys).agg(F.sort_array(F.collect_list("_o")).alias("s"))
        length = F.size("s")
        at, spread = F.col("k") / F.col("m") * length, 2.0 * F.sqrt(length.cast("double")) + 2.0
        lo, hi = F.floor(at - spread).cast("int"), (F.floor(at + spread) + 1).cast("int")
        whole = F.col("m") <= size
        middle = (lo < 0) & (hi >= length) & (length > 0)  # a sample too small for a bracket halves the rows
        pick = lambda i: F.when((i >= 0) & (i < length), F.get("s", i))
        exact = F.get("s", F.col("k").cast("int"))
        half = F.get("s", (length / 2).cast("int"))
        asks = (_null_safe_left(todo, some, keys)
                .withColumn("a", F.when(whole, exact).when(middle, half).otherwise(pick(lo)))
                .withColumn("b", F.when(whole, exact).when(middle, half).otherwise(pick(hi))).drop("s"))
        asks = materialize(asks, "cut-splitters")
        rows = _with_groups(slim, asks, keys, n_groups).where(inside)
        a, b = F.col("a"), F.col("b")
        one = a.isNotNull() & a.eqNullSafe(b)
        sides = [a.isNotNull() & (o < a), a.isNotNull() & (o == a),
                 ~one & (a.isNull() | (o > a)) & (b.isNull() | (o < b)), ~one & b.isNotNull() & (o == b), b.isNotNull() & (o > b)]
        counts = rows.groupBy(*keys).agg(*[F.count_if(s).alias(f"c{i}") for i, s in enumerate(sides)])
        done = _null_safe_left(asks, counts, keys)
        c = [F.coalesce(F.col(f"c{i}"), F.lit(0)) for i in range(5)]
        sums = [F.lit(0), c[0], c[0] + c[1], c[0] + c[1] + c[2], c[0] + c[1] + c[2] + c[3]]
        part = F.when(F.col("k") < sums[1], 0).when(F.col("k") < sums[2], 1).when(F.col("k") < sums[3], 2).when(
            F.col("k") < sums[4], 3).otherwise(4)
        by_part = lambda values: F.element_at(F.array(*values), F.col("part") + 1)
        done = materialize(done.withColumn("part", part).withColumn("before", by_part([s.cast("long") for s in sums]))
                           .withColumn("own", by_part([x.cast("long") for x in c])), "cut-counts")
        hit = done.where("part IN (1, 3)").select(
            *keys, F.when(F.col("part") == 1, a).otherwise(b).alias("cut"), (F.col("base") + F.col("before")).alias("below"),
            F.col("own").alias("equal"), "take")
        found = hit if found is None else found.unionByName(hit)
        lows = [F.col("lo"), F.col("lo"), F.coalesce(a, F.col("lo")), F.col("lo"), b]
        highs = [a, F.col("hi"), F.coalesce(b, F.col("hi")), F.col("hi"), F.col("hi")]
        todo = materialize(done.where("part NOT IN (1, 3)").select(
            *keys, "take", by_part(lows).alias("lo"), by_part(highs).alias("hi"), (F.col("k") - F.col("before")).alias("k"),
            F.col("own").alias("m"), (F.col("base") + F.col("before")).alias("base")), "cut-brackets")


def _null_safe_left(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    side = right.withColumnsRenamed({k: f"_key_{i}" for i, k in enumerate(keys)})
    if not keys:
        return left.join(side, F.lit(True), "left")  # one row each
    on = [F.col(f"`{k}`").eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    return left.join(side, on, "left").drop(*[f"_key_{i}" for i in range(len(keys))])


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence, wanted: DataFrame, out: str,
               most: int = MOST) -> DataFrame:
    """``df`` with the boolean ``out``: the row is one of the first ``take`` of its group.

    ``order``: columns; ``wanted``: (keys, n, take), a row for each group that occurs.  Nulls
    are a group, and the least values of the order.  Rows equal in the whole order are
    interchangeable: as many of them are flagged as fit."""
    own, keys = list(keys), [f"_g{i}" for i in range(len(keys))]
    wanted = materialize(wanted.select(*[F.col(f"`{c}`").alias(g) for c, g in zip(own, keys)], "n", "take"), "cut-groups")
    n_groups = wanted.count()
    d = df.withColumn("_o", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
    d = d.withColumns({g: F.col(f"`{c}`") for c, g in zip(own, keys)})
    cuts = _cuts(d.select(*keys, "_o"), keys, wanted.where("take > 0 AND take < n"), most)
    plan = materialize(_null_safe_left(wanted, cuts.drop("take"), keys)
                       .withColumnsRenamed({c: f"_cut_{c}" for c in ("n", "take", "cut", "below", "equal")}), "cut-values")
    n, take, cut, equal, below = (F.col(f"_cut_{c}") for c in ("n", "take", "cut", "equal", "below"))
    torn = (below < take) & (take < below + equal)
    flag = F.when(take >= n, True).when(take <= 0, False).otherwise(
        (F.col("_o") < cut) | ((F.col("_o") == cut) & (take >= below + equal)))
    marked = _with_groups(d, plan, keys, n_groups)
    tied = F.coalesce(torn & (F.col("_o") == cut), F.lit(False))
    names = [*(f"`{c}`" for c in df.columns)]
    if plan.where(torn).isEmpty():
        return marked.withColumn(out, flag).select(*names, out)
    # rows equal in the whole order, of the groups whose cut they straddle: dealt at random
    ties = marked.where(tied).withColumn("_salt", F.rand(13)).withColumn("_left", take - below).drop("_o", "_cut_cut")
    ranked, _ = global_index(ties, ["_salt"], keys, rn="_rank")
    rest = marked.where(~tied).withColumn(out, flag).select(*names, out)
    return rest.unionByName(ranked.withColumn(out, F.col("_rank") < F.col("_left")).select(*names, out))
