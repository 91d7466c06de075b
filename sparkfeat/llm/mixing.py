"""Mixing sources to target weights by a time-varying curriculum (operator 3).

Every source has a weight and a weight schedule over training time [0, 1].  Targets
are ``share`` of all words dealt by weight, stopped at ``most`` times a source's size,
the excess reshared by weight (water-filling, closed form over the sources sorted by
limit / weight).  A schedule is piecewise linear; its integral, scaled to the target,
is the source's cumulative token demand.  The documents of a source follow each other
in hash order, pass after pass, until the target is used up; the position of a copy is
the time at which the demand reaches the words before it, i.e. the inverse of the
integral.  ``training_order`` range-sorts the copies by position.

Words before a document come from three bounded steps, so a source with a third of all
rows is never one task: sums per (source, hash bucket), a running sum over a source's
buckets (at most 65,536 rows), and a running sum inside a bucket.

Defined results: null text has size 0 and takes nothing; a null source is a source of
its own, last in order; null ids and repeated rows are kept, each row is mixed by
itself; equal rows are interchangeable; an empty table gives an empty result.  A
document at the end of its source's target is taken in part (``taken`` counts words).
"""
from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize, running_sum, wide_key

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
#: (time, level) knots for each weight: light sources fade out, heavy ones come in.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))


def integrate(schedule) -> list[tuple[float, float, float, float]]:
    """Segments (time, level, slope, integral before), the whole integral being 1."""
    if schedule[0][0] != 0 or schedule[-1][0] != 1 or any(w < 0 for _, w in schedule):
        raise ValueError("a schedule runs from time 0 to 1 with levels of 0 or more")
    total = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:]))
    if total <= 0:
        raise ValueError("a schedule needs a positive integral")
    out, done = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        if t1 > t0:
            out.append((t0, w0 / total, (w1 - w0) / total / (t1 - t0), done))
            done += (t1 - t0) * (w0 + w1) / 2 / total
    return out


def position_at(segments, u: Column) -> Column:
    """The time at which the integral reaches ``u``."""
    def inside(t0, w0, slope, before):
        x = u - F.lit(before)
        root = F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * x, F.lit(0.0)))
        return F.when(root > 0, F.lit(t0) + F.lit(2.0) * x / root).otherwise(F.lit(t0))
    out = inside(*segments[0])
    for s in segments[1:]:
        out = F.when(u >= F.lit(s[3]), inside(*s)).otherwise(out)
    return out


def targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.0, most: int = 3) -> DataFrame:
    """``sources`` (key, source, source_size; one row a source) with kind, weight and target."""
    n = len(weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = functools.reduce(lambda x, i: F.when(F.col("kind") == i, F.lit(weights[i])).otherwise(x),
                              range(1, n), F.lit(weights[0]))
    s = (sources.withColumn("kind", (F.row_number().over(by_name) - 1) % n).withColumn("weight", weight)
         .withColumn("limit", (F.col("source_size") * most).cast("long")))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(whole) * F.lit(float(share))
                               - F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)),
                                            F.lit(0)))
                     / F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
    open_level = F.min(F.when(F.col("level") < F.col("limit") / F.col("weight"),
                              F.struct(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source", "level")))
    s = s.withColumn("even", open_level.over(whole)["level"])
    return s.select("key", "source_size", "kind",
                    F.when(F.col("even").isNull(), F.col("limit").cast("double"))
                    .otherwise(F.least(F.col("limit").cast("double"), F.col("even") * F.col("weight"))).alias("target"))


def _row(docs: DataFrame):
    return wide_key(*(F.col(f"`{c}`") for c in docs.columns))


def curriculum_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   weights=WEIGHTS, schedules=SCHEDULES, share: float = 1.0, most: int = 3) -> DataFrame:
    """One row for each row of ``docs``: id, source, size, source_size, target, taken,
    ``positions``, the training time of every copy (empty if nothing is taken), and
    ``row``, the key of the whole row."""
    if len(schedules) != len(weights):
        raise ValueError("one schedule for each weight")
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0))
                        .cast("long").alias("size"),
                        _row(docs).alias("row"))
            .withColumn("h", F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")))
            .withColumn("key", key))
    rows = running_sum(materialize(rows, "mix-rows"), ["key"], ["h", "id", "size", "row"], "size", "start")
    sources = rows.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    out = rows.join(targets(sources, weights, share, most), "key").withColumn("words", F.floor("target"))
    size, total, words = F.col("size"), F.col("source_size"), F.col("words")
    passes = F.when(total > 0, F.floor(words / total)).otherwise(F.lit(0))
    # floor of a double quotient: settle it in whole numbers
    passes = F.when(passes * total > words, passes - 1).otherwise(passes)
    rest = F.greatest(F.lit(0), F.least(size, words - F.col("passes") * total - F.col("start")))
    out = out.withColumn("passes", passes.cast("long")).withColumn("taken", (F.col("passes") * size + rest).cast("long"))
    copies = F.when(F.col("taken") > 0, F.ceil(F.col("taken") / size)).otherwise(F.lit(0)).cast("int")
    def at(i):
        u = (i * F.col("source_size") + F.col("start")) / F.col("words")
        return functools.reduce(
            lambda x, j: F.when(F.col("kind") == j, position_at(integrate(schedules[j]), u)).otherwise(x),
            range(1, len(schedules)), position_at(integrate(schedules[0]), u))
    out = out.withColumn("copies", copies)
    return out.select("id", "source", "size", "source_size", "target", "taken", "row", F.when(
        F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.col("copies") - 1, F.lit(0))), at)
    ).otherwise(F.array().cast("array<double>")).alias("positions"))


def training_order(mix: DataFrame) -> DataFrame:
    """One row a copy, range-sorted by position."""
    return (mix.select("*", F.posexplode("positions").alias("copy", "position")).drop("positions")
            .orderBy("position", "id", "copy"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents with their own columns, a row for each copy that the mix takes (a
    document taken in part counts as a copy), range-sorted by position."""
    mix = curriculum_mix(docs, id_col, text_col, source_col, **options).where(F.size("positions") > 0)
    k, t = fresh(docs, "_row"), fresh(docs, "_time")
    mix = mix.select(F.col("row").alias(k), F.explode("positions").alias(t))
    keyed = docs.withColumn(k, _row(docs))
    # rows equal in every column meet in one, which takes the positions of all
    return (keyed.dropDuplicates([k]).join(mix, k).orderBy(t, k)
            .select(*(F.col(f"`{c}`") for c in docs.columns)))


def op3_curriculum_mix(spark, sf_dir):
    mix = curriculum_mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return (mix.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken",
                       F.size("positions").cast("long").alias("copies"), F.get("positions", F.lit(0)).alias("first_position"))
            .orderBy(F.col("first_position").asc_nulls_last(), "doc_id"))


ORACLE = """
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
k AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) AS kind FROM s),
w AS (SELECT *, kind + 1 AS weight, 3 * source_size AS lim FROM k),
l AS (SELECT *, CAST(lim AS DOUBLE) / weight AS ratio,
        (CAST(sum(source_size) OVER () AS DOUBLE)
         - coalesce(CAST(sum(lim) OVER (ORDER BY CAST(lim AS DOUBLE) / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0))
        / CAST(sum(weight) OVER (ORDER BY CAST(lim AS DOUBLE) / weight, source NULLS LAST
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS lev
      FROM w),
e AS (SELECT lev AS even FROM l WHERE lev < ratio ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT l.source, source_size, kind,
        CASE WHEN (SELECT even FROM e) IS NULL THEN CAST(lim AS DOUBLE)
             ELSE least(CAST(lim AS DOUBLE), (SELECT even FROM e) * weight) END AS target FROM l),
p AS (SELECT doc_id, source, size,
        CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM d),
q AS (SELECT p.doc_id, p.size, t.source_size, t.target, t.kind, p.start, CAST(floor(t.target) AS BIGINT) AS words,
        CASE WHEN t.source_size > 0 THEN CAST(floor(t.target) AS BIGINT) // t.source_size ELSE 0 END AS passes
      FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source),
r AS (SELECT *, CAST(passes * size + greatest(0, least(size, words - passes * source_size - start)) AS BIGINT) AS taken
      FROM q),
u AS (SELECT *, CASE WHEN taken > 0 THEN CAST(ceil(CAST(taken AS DOUBLE) / size) AS BIGINT) ELSE 0 END AS copies,
        CASE WHEN taken > 0 THEN CAST(start AS DOUBLE) / words END AS x FROM r)
SELECT doc_id, size, source_size, target, taken, copies,
  CASE kind WHEN 0 THEN 2.0::DOUBLE * x / (1.5::DOUBLE + sqrt(greatest(2.25::DOUBLE + -2.0::DOUBLE * x, 0.0::DOUBLE)))
            WHEN 1 THEN 2.0::DOUBLE * x / (1.0::DOUBLE + sqrt(greatest(1.0::DOUBLE + 0.0::DOUBLE * x, 0.0::DOUBLE)))
            ELSE CASE WHEN x >= 0.375::DOUBLE
              THEN 0.5::DOUBLE + 2.0::DOUBLE * (x - 0.375::DOUBLE)
                   / (1.0::DOUBLE + sqrt(greatest(1.0::DOUBLE + 2.0::DOUBLE * (x - 0.375::DOUBLE), 0.0::DOUBLE)))
              ELSE 2.0::DOUBLE * x / (0.5::DOUBLE + sqrt(greatest(0.25::DOUBLE + 2.0::DOUBLE * x, 0.0::DOUBLE))) END
  END AS first_position
FROM u
"""
