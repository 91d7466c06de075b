"""Sharding by balanced label propagation (operator 10), under the law ``rows``.

Documents that share a group (equal texts by default) are linked.  Every document
starts in the shard of its rank by hash modulo the number of shards, so counts differ
by one at most.  In each round a linked document looks at its neighbours' shards: for
each of its groups, the members by shard.  It asks to move to the open shard with most
neighbours if that has more than its own (ties by a hash of round, group and shard, so
that a group agrees).  Asks are admitted by pair of shards, the largest gains first: as
many each way as close a cycle (linked documents change places with each other), then as
many as the shard asked for has unlinked documents to give away; those change places with
the documents that moved, at no cost in links.  So counts stay as they were in every
round.  In every other round the only shards open are those with unlinked documents and
those that somebody still asks to leave; so a group larger than a shard fills one and goes on with the next.  It ends when
nobody may move, or after ``rounds``.

Where groups are disjoint (equal texts), the rounds run on counts by (group, shard)
alone (``settle``): a row for each that occurs, joined with its group's best shard; moves
are counts too, and documents are touched once at the end, when each takes the shard of
its rank in its group.  Rounds end when nobody may move.  Groups still cut then (asks wait
in full shards, and no cycle gives room) are laid out anew among themselves, one after the
other over the places that they hold, shard by shard: a running sum of their sizes against
that of the places.  So every shard keeps its count, and fewer groups than shards stay
cut, besides those larger than a shard.
``propagate`` is the form for documents in several groups: there the members join the
counts.  Nothing is ever formed per pair.  A group with a third of all rows has as many
count rows as shards and is ranked by range partitions.  Unlinked documents take no part
in the rounds: only their number counts until the end.

Defined results: null text has size 1, checksum 0 and no links; empty texts are equal
texts; null ids and repeated rows each get a slot of their own (equal rows are
interchangeable); an empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.order import global_index
from .common import materialize, running_sum

SHARDS = 8
ROUNDS = 12


def _cycle(asks: dict[tuple[int, int], int]) -> list[tuple[int, int]] | None:
    """A shortest closed chain of asks (left, shard)."""
    best = None
    for start in sorted({a for a, _ in asks}):
        way, front = {start: []}, [start]
        while front:
            found = []
            for a in front:
                for x, y in sorted(k for k in asks if k[0] == a):
                    if y == start and (best is None or len(way[a]) + 1 < len(best)):
                        best = [*way[a], (x, y)]
                    if y not in way:
                        way[y] = [*way[a], (x, y)]
                        found.append(y)
            front = found
    return best


def admitted(wanted: dict[tuple[int, int], int], room: dict[int, int]) -> dict[tuple[int, int], int]:
    """How many of the asks (left, shard) are met, so that nobody's room falls below 0;
    ``room`` is updated in place."""
    left, met = {k: n for k, n in wanted.items() if n > 0}, {}

    def meet(pair, n):
        met[pair] = met.get(pair, 0) + n
        left[pair] -= n
        if not left[pair]:
            del left[pair]

    while cycle := _cycle(left):
        n = min(left[p] for p in cycle)
        for p in cycle:
            meet(p, n)
    # no cycles are left, so the room that a move makes in the shard behind it comes to an end
    while pairs := sorted(p for p in left if room[p[1]] > 0):
        for a, b in pairs:
            if n := min(left[a, b], room[b]):
                meet((a, b), n)
                room[b] -= n
                room[a] += n
    return met


def propagate(members: DataFrame, start: DataFrame, room: dict[int, int], shards: int, rounds: int = ROUNDS) -> DataFrame:
    """Final (rn, shard) of the linked documents.

    ``members`` (rn, g): the groups of each; ``start`` (rn, shard); ``room``: the unlinked
    documents of each shard, updated in place."""
    place, leaving, stalled = start, set(range(shards)), 0
    for turn in range(rounds):
        open_shards = [s for s in range(shards) if turn % 2 == 0 or room[s] > 0 or s in leaving]
        if not open_shards:
            continue
        here = members.join(place, "rn")
        counts = here.groupBy("g", "shard").agg(F.count("*").alias("n"))
        seen = members.join(counts, "g").groupBy("rn", "shard").agg(
            F.sum("n").alias("n"), F.max(F.xxhash64(F.lit(turn), "g", "shard")).alias("tie"))
        seen = seen.join(place.withColumnRenamed("shard", "own"), "rn")
        rank = F.struct("n", "tie", "shard")
        best = seen.groupBy("rn").agg(
            F.max(F.when(F.col("shard").isin(open_shards), rank)).alias("to"),
            F.max(F.when(F.col("shard") == F.col("own"), rank)).alias("at"))
        asks = (best.where("to > at").join(members.groupBy("rn").agg(F.min("g").alias("g")), "rn")
                .select("rn", F.col("to.shard").alias("shard"), F.col("at.shard").alias("left"),
                        (F.col("at.n") - F.col("to.n")).alias("loss"), "g"))
        asks = materialize(asks, "shard-asks")
        wanted = {(r["left"], r["shard"]): r["count"] for r in asks.groupBy("left", "shard").count().collect()}  # a row a pair of shards
        met = admitted(wanted, room)
        if not met:
            stalled += 1
            if (not wanted and turn % 2 == 0) or (stalled > 1 and any(room.values())):
                break
            leaving = set()  # the shards with room alone, then other ties
            continue
        stalled = 0
        leaving = {a for (a, b), n in wanted.items() if met.get((a, b), 0) < n}
        if met != wanted:
            ranked, _ = global_index(asks, ["loss", "g", "rn"], partition_by=["left", "shard"], rn="turn")
            pair = F.col("left") * shards + F.col("shard")
            quota = F.create_map(*(F.lit(int(x)) for (a, b), n in met.items() for x in (a * shards + b, n)))
            asks = materialize(ranked.where(F.col("turn") < F.coalesce(F.try_element_at(quota, pair), F.lit(0))), "shard-moves")
        moved = asks.select("rn", F.col("shard").alias("to"))
        place = materialize(place.join(moved, "rn", "left")
                            .select("rn", F.coalesce("to", "shard").alias("shard")), "shard-places")
    return place


def _admit(asks: DataFrame, quota: dict[tuple[int, int], int]) -> DataFrame:
    """(g, left, shard, n): the asks of most gain by pair of shards, up to its quota; the last
    is met in part."""
    bound = F.create_map(*(F.lit(int(x)) for (a, b), n in quota.items() for x in (a * 1_000 + b, n)))
    asks = asks.withColumn("quota", F.try_element_at(bound, F.col("left") * 1_000 + F.col("shard"))).where("quota > 0")
    met = F.least("n", F.col("quota") - F.col("before"))
    return running_sum(asks, ["left", "shard"], ["loss", "g"], "n", "before").select("g", "left", "shard", met.cast("long").alias("n")).where("n > 0")


def _relay(place: DataFrame, shards: int) -> DataFrame:
    """The cut groups laid out one after the other over the places that they hold."""
    held = {r["shard"]: r["n"] for r in place.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # a row a shard
    spans, at = [], 0
    for s in range(shards):
        spans.append(F.struct(F.lit(s).alias("shard"), F.lit(at).cast("long").alias("lo"), F.lit(at + held.get(s, 0)).cast("long").alias("hi")))
        at += held.get(s, 0)
    groups = place.groupBy("g").agg(F.first("total").alias("n")).withColumn("big", -F.col("n"))
    groups = running_sum(groups, [], ["big", "g"], "n", "before")
    part = F.least(F.col("before") + F.col("total"), F.col("hi")) - F.greatest("before", "lo")
    return (groups.withColumnRenamed("n", "total").select("g", "total", "before", F.inline(F.array(*spans)))
            .select("g", "shard", part.alias("n"), "total").where("n > 0"))


def _totals(asks: DataFrame) -> dict[tuple[int, int], int]:
    return {(r["left"], r["shard"]): r["n"] for r in asks.groupBy("left", "shard").agg(F.sum("n").alias("n")).collect()}


def _moved(place: DataFrame, moves: DataFrame) -> DataFrame:
    """``place`` after the moves (g, left, shard, n)."""
    out = place.select("g", "shard", "n", "total")
    gone = moves.select("g", F.col("left").alias("shard"), (-F.col("n")).alias("n"), F.lit(None).cast("long").alias("total"))
    come = moves.select("g", "shard", "n", F.lit(None).cast("long").alias("total"))
    out = out.unionByName(gone).unionByName(come).groupBy("g", "shard").agg(F.sum("n").alias("n"))
    size = place.groupBy("g").agg(F.first("total").alias("total"))
    return materialize(out.where("n > 0").join(size, "g"), "shard-places")


def settle(place: DataFrame, room: dict[int, int], shards: int) -> DataFrame:
    """Balanced propagation over disjoint groups.  ``place`` (g, shard, n, total): members of
    a group by shard, and in all; ``room``: the unlinked documents of each shard, updated in
    place.  The counts by shard, rooms included, stay as they are."""
    turn, idle, leaving = 0, 0, set()
    while idle < 3:
        # all shards; those with room or that somebody asks to leave; those with room
        open_shards = [s for s in range(shards) if turn % 3 == 0 or room[s] > 0 or (turn % 3 == 1 and s in leaving)]
        turn += 1
        if not open_shards:
            idle += 1
            continue
        rank = F.struct("n", F.xxhash64(F.lit(turn), "g", "shard").alias("tie"), "shard")
        best = place.groupBy("g").agg(F.max(F.when(F.col("shard").isin(open_shards), rank)).alias("to"))
        split = place.where("n < total").withColumn("at", rank).join(best.where("to is not null"), "g").where("to > at")
        asks = materialize(split.select("g", F.col("shard").alias("left"), F.col("to.shard").alias("shard"), "n",
                                        (F.col("n") - F.col("to.n")).alias("loss")), "shard-wanted")
        wanted = _totals(asks)  # a row a pair of shards
        met = admitted(wanted, room)
        leaving = {a for (a, b), n in wanted.items() if met.get((a, b), 0) < n}
        idle = 0 if met else idle + 1
        if met:
            place = _moved(place, asks.drop("loss") if met == wanted else _admit(asks, met))
    cut = place.where("n < total")
    if cut.select("g").distinct().count() >= shards:
        place = materialize(place.where("n = total").unionByName(_relay(cut, shards)), "shard-places")
    return place


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row; counts at most one apart."""
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("g"))
    rows = rows.withColumn("h", F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")))
    ranked, _ = global_index(rows, ["h", "id", "g"])
    ranked = materialize(ranked.drop("h").withColumn("shard", F.pmod("rn", F.lit(shards)).cast("int")), "shard-rows")
    total = ranked.count()

    place = ranked.where("g is not null").groupBy("g", "shard").agg(F.count("*").alias("n"))
    place = place.withColumn("total", F.sum("n").over(Window.partitionBy("g"))).where("total > 1")  # at most a row a shard
    place = materialize(place, "shard-linked")
    room = {s: (total - s + shards - 1) // shards for s in range(shards)}
    linked = 0
    for r in place.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # a row a shard
        room[r["shard"]] -= r["n"]
        linked += r["n"]
    place = settle(place, room, shards)
    upto = F.sum("n").over(Window.partitionBy("g").orderBy("shard"))
    ends = place.withColumn("upto", upto).groupBy("g").agg(F.array_sort(F.collect_list(F.struct("upto", "shard"))).alias("ends"))
    members, _ = global_index(ranked.join(place.select("g").distinct(), "g").select("rn", "g"), ["rn"], partition_by=["g"], rn="k")
    place = materialize(members.join(ends, "g").select(
        "rn", F.element_at(F.filter("ends", lambda e: e["upto"] > F.col("k")), 1)["shard"].alias("shard")), "shard-members")

    free = ranked.join(place.select("rn"), "rn", "left_anti").select("rn")
    free, _ = global_index(free, ["rn"], rn="turn")
    shard, before = F.lit(shards - 1), total - linked
    for s in reversed(range(1, shards)):
        before -= room[s]
        shard = F.when(F.col("turn") < before, F.lit(s - 1)).otherwise(shard)
    final = place.select("rn", F.col("shard").cast("int").alias("to")).union(
        free.select("rn", shard.cast("int").alias("to")))
    out = ranked.drop("shard").join(final, "rn").withColumnRenamed("to", "shard")
    out, _ = global_index(out.select("id", "size", "text_crc32", "g", "shard", "rn"), ["rn"],
                          partition_by=["shard"], rn="slot")
    return out.drop("rn", "g")


def op10_label_sharding(spark, sf_dir):
    out = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
