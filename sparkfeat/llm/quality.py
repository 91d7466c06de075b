"""Quality classifier by importance resampling (operator 7).

Two generative models over hashed word unigrams and bigrams: one of the target text
(documents labelled good and not toxic, from a bounded sample of labelled rows) and one
of the raw text (every document).  A document's log weight is the sum, over its
n-grams, of log(target share / raw share).  Documents are drawn without replacement in
proportion to their weights by Gumbel top-k: the k largest of log weight + Gumbel
noise.  The noise is a hash of seed, id and text, so reruns and retries agree.

A few off-target words in a long text hardly move that sum, so they count by themselves: a
word's score is the log ratio of its shares of labelled documents, rejected (toxic ones
included) to target; full hashes of words in ``MIN_BAD`` rejected documents or more are
kept.  A document whose worst word reaches the bar has weight 0 (key minus infinity).  The
bar is the lowest that turns down at most two thousandths of the held-out target documents;
there is none if it catches no held-out rejected one.

k is a parameter; by default it is the number of documents below the bar whose log weight reaches the
level that target documents held out of the model (a fifth of the sample) reach: 3 below
their lowest two thousandths (or below 0), 3 being all that Gumbel noise takes off a
document.

The raw counts cover all words of all documents; a task sends at most ``BUCKETS`` rows.
The k-th largest key comes from a range-partitioned index; what is kept is then a filter
on the key, so texts are never shuffled.

Defined results: null or wordless text has weight 0 (a likelihood ratio of 1); null ids
are kept and drawn like others; equal rows have equal keys and go or stay together
(rows tied with the k-th key are all kept); labels that contradict each other or are
null are not used; without usable target labels every document is kept; an empty table
gives an empty result.
"""
from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.order import global_index
from .common import fresh, materialize, trimmed
from .textkit import mix, words

BUCKETS = 1 << 14
MAX_LABELS = 20_000  # labelled rows used, by hash order of the id
SMOOTH = 0.5
MIN_BAD, MIN_SCORE = 5, 3.0  # rejected documents with a word that counts by itself; its least score
LOSE, SLACK = 0.002, 3.0  # quantile of the held-out target weights, and room for the noise


def _features(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every unigram and bigram."""
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    one = (mix(h, 21) & np.uint64(BUCKETS - 1)).astype(np.int64)
    pair = mix(h[:-1] * np.uint64(0xD6E8FEB86659FD93) + h[1:], 22) if len(h) > 1 else np.empty(0, np.uint64)
    inside = row[:-1] == row[1:]
    two = (pair & np.uint64(BUCKETS - 1)).astype(np.int64)[inside]
    return np.concatenate([one, two]), np.concatenate([row, row[:-1][inside]])


def _count(batches):
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        good = batch.column(1).fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
        for first, h, off in words(batch.column(0)):
            f, row = _features(h, off)
            raw += np.bincount(f, minlength=BUCKETS)
            target += np.bincount(f[good[first + row]], minlength=BUCKETS)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], ["f", "raw", "target"])


def label_sample(labels: DataFrame, id_col: str = "doc_id", limit: int = MAX_LABELS) -> DataFrame:
    """(id, good, held) for at most ``limit`` labelled ids whose labels agree; a fifth is
    held out of the model."""
    one = labels.select(F.col(id_col).alias("id"), ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
                        .alias("good")).where("id is not null and good is not null")
    return (one.groupBy("id").agg(F.min("good").alias("good"), F.max("good").alias("_max"))
            .where("good = _max").select("id", "good", (F.pmod(F.xxhash64(F.lit("held"), "id"), F.lit(5)) == 0).alias("held"))
            .orderBy(F.xxhash64("id"), "id").limit(limit))


def fit(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """log(target share / raw share) of every bucket."""
    text = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"))
    marked = text.join(F.broadcast(sample), "id", "left").select("text", (F.col("good") & ~F.col("held")).alias("good"))
    rows = (marked.mapInArrow(trimmed(_count), "f long, raw long, target long").groupBy("f")
            .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())  # BUCKETS rows at most
    raw, target = np.full(BUCKETS, SMOOTH), np.full(BUCKETS, SMOOTH)
    for f, r, t in rows:
        raw[f] += r
        target[f] += t
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def _distinct_words(batches):
    """(text, row) -> (row, f): the distinct words of each text, as hashes."""
    for batch in batches:
        for first, h, off in words(batch.column(0)):
            row = np.repeat(np.arange(len(off) - 1), np.diff(off))
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))[:len(h)]
            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(first + row[new])),
                                              pa.array(h[new].view(np.int64))], ["id", "f"])


def bar(good: list[float], bad: list[float], lose: float = LOSE) -> float:
    """The lowest score that turns down at most ``lose`` of the held-out target documents."""
    spare = sorted(good, reverse=True)[int(lose * len(good)):]  # those that must stay
    caught = [s for s in bad if s > max(spare, default=float("inf"))]
    return min(caught, default=float("inf"))


def off_target(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words that turn a document down by themselves, sorted, and their scores."""
    kind = docs.schema[id_col].dataType.simpleString()
    text = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"))
    marked = text.join(F.broadcast(sample.select("id")), "id").select("text", "id")
    held = materialize(marked.mapInArrow(trimmed(_distinct_words), f"id {kind}, f long").distinct()
                       .join(F.broadcast(sample), "id"), "quality-words")
    size = {(r["good"], r["held"]): r["count"] for r in sample.groupBy("good", "held").count().collect()}
    bad, good = (size.get((g, False), 0) for g in (False, True))
    score = F.log((F.col("bad") + SMOOTH) / (bad + 1)) - F.log((F.col("fine") + SMOOTH) / (good + 1))
    scores = materialize(held.where("not held").groupBy("f").agg(
        F.count_if(~F.col("good")).alias("bad"), F.count_if("good").alias("fine"))
        .where(F.col("bad") >= MIN_BAD).select("f", score.alias("score")).where(F.col("score") >= MIN_SCORE), "quality-scores")
    worst = held.where("held").join(scores, "f", "left").groupBy("id", "good").agg(
        F.coalesce(F.max("score"), F.lit(0.0)).alias("score")).collect()  # labelled ids at most
    least = bar([r["score"] for r in worst if r["good"]], [r["score"] for r in worst if not r["good"]])
    # each row takes MIN_BAD labelled documents, so labelled text bounds them
    rows = scores.where(F.col("score") >= F.lit(least)).orderBy("f").collect()
    return np.array([r["f"] for r in rows], np.int64), np.array([r["score"] for r in rows])


def _turned_down(stops):
    @F.arrow_udf("boolean")
    def turned_down(text: pa.Array) -> pa.Array:
        out, stop = np.zeros(len(text), bool), stops.value
        for first, h, off in words(text):
            if len(stop) and len(h):
                h = h.view(np.int64)
                at = np.flatnonzero(stop[np.minimum(np.searchsorted(stop, h), len(stop) - 1)] == h)
                out[first + np.searchsorted(off, at, side="right") - 1] = True
        return pa.array(out)
    return turned_down


def _weigh(model):
    @F.arrow_udf("double")
    def weigh(text: pa.Array) -> pa.Array:
        out = np.zeros(len(text))
        for first, h, off in words(text):
            f, row = _features(h, off)
            out[first:first + len(off) - 1] = np.bincount(row, model.value[f], minlength=len(off) - 1)
        return pa.array(out)
    return weigh


def with_weights(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 seed: int = 7, weight: str = "log_weight", key: str = "sample_key",
                 max_labels: int = MAX_LABELS) -> tuple[DataFrame, DataFrame]:
    """``docs`` with log weight and Gumbel key, and the label sample."""
    sample = materialize(label_sample(labels, limit=max_labels), "quality-labels")
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, sample, id_col, text_col))
    text = F.col(text_col).cast("string")
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), text), 11)
               .cast("double") + 0.5) / float(1 << 53)
    stops = docs.sparkSession.sparkContext.broadcast(off_target(docs, sample, id_col, text_col)[0])
    scored = docs.withColumn(weight, _weigh(model)(text))
    drawn = F.col(weight) - F.log(-F.log(uniform))
    return scored.withColumn(key, F.when(_turned_down(stops)(text), F.lit(float("-inf"))).otherwise(drawn)), sample


def level(weights: list[float], lose: float = LOSE, slack: float = SLACK) -> float | None:
    """``slack`` below the ``lose`` quantile of held-out target documents' weights, or below
    0: what is as likely in the target as in the raw text is never turned down."""
    return min(0.0, float(np.quantile(weights, lose, method="lower"))) - slack if weights else None


def selection(scored: DataFrame, sample: DataFrame, id_col: str, weight: str, key: str,
              k: int | None = None) -> float | None:
    """The smallest key that is kept (None: all are)."""
    small = materialize(scored.select(F.col(id_col).alias("id"), F.col(weight).alias("w"), F.col(key).alias("key")),
                        "quality-keys")
    drawn = F.col("key") > F.lit(float("-inf"))
    if k is None:
        # one row a labelled id, so the number of rows is bounded by the sample
        rows = (small.join(F.broadcast(sample.where("good and held")), "id").groupBy("id")
                .agg(F.min("w").alias("w")).collect())
        least = level([r["w"] for r in rows])
        if least is None:
            return None
        k = small.where((F.col("w") >= least) & drawn).count()
    if k <= 0:
        return float("inf")
    # documents that are turned down share one key: they are not ranked, and never kept
    ranked, _ = global_index(small.where(drawn).select((-F.col("key")).alias("down")), ["down"])
    last = ranked.where(F.col("rn") == k - 1).first()
    return -sys.float_info.max if last is None else -last["down"]


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             k: int | None = None, seed: int = 7, weight: str = "log_weight", key: str = "sample_key") -> DataFrame:
    """The documents drawn, with their weights and keys."""
    scored, sample = with_weights(docs, labels, id_col, text_col, seed, weight, key)
    least = selection(scored, sample, id_col, weight, key, k)
    return scored if least is None else scored.where(F.col(key) >= F.lit(least))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents drawn, with their own columns."""
    w, g = fresh(docs, "log_weight"), fresh(docs, "sample_key")
    return resample(docs, labels, weight=w, key=g).drop(w, g)


def op7_quality_resampling(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(
        "doc_id", "log_weight", "sample_key", F.lit(True).alias("kept"))
