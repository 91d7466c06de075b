"""Benchmark decontamination by pigeonhole edit matching (operator 6).

A document holds a test item if some run of its words is within ``k`` word edits
(insert, delete, replace) of the item's words, k being a quarter of them, i.e. a
similarity of 0.75 or more.  Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased.
An item is split into k+1 pieces; k edits leave one piece untouched, so every match
holds an exact piece.

The work is four Spark steps, none of which brings items or documents to the driver:

1. the items' distinct word sequences become a table of pieces (hash, width, offset);
2. one scan of the documents looks the rolling hashes of each text up in a bitmap of the
   piece hashes (16 MB at most, however many items there are), and what it lets through
   is joined with the pieces: candidates of (text, sequence) with their places;
3. the candidates of a text are packed by ``BLOCK_WORDS`` words of items, so a text that
   holds pieces of very many items meets them in many tasks, and joined with the words
   of the text; equal texts and equal items are one here;
4. around each place the Myers bit-parallel recurrence, one machine word operation a text
   word over a bit vector as long as the item, gives the least edit distance.

Only texts with a candidate are shuffled, once each, and of the documents themselves only
those that a bitmap of the matched texts doesn't clear.

Defined results: null or wordless text or item matches nothing; items shorter than 4
words must occur unchanged; repeated documents each get their rows, repeated items
keep their ids (of any type, null too); an empty table on either side gives no matches;
further columns may have any name.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap, fresh, materialize, maybe, trimmed, wide_key
from .textkit import rolling, words

BLOCK_WORDS = 100_000  # words of test items that meet one copy of a text
BITS = 20, 27  # least and most bits (as powers of two) of the bitmap of piece hashes
TEXT, SEQUENCE = ["t1", "t2"], ["s1", "s2"]  # 128-bit keys


def budget(n_words: int, num: int = 75, den: int = 100) -> int:
    """Word edits allowed for an item of ``n_words`` words."""
    return n_words * (den - num) // den


def pieces(n_words: int, k: int) -> list[tuple[int, int]]:
    """k+1 runs (offset, length) that cover an item evenly."""
    cut = [n_words * i // (k + 1) for i in range(k + 2)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def myers(masks: dict[int, int], m: int, text) -> tuple[int, int]:
    """Least edit distance between the pattern and any run of ``text``, and the end of
    the first run that has it.  ``masks``: for each symbol, the pattern's positions."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, symbol in enumerate(text, 1):
        equal = masks.get(symbol, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (~(horizontal | plus) & full)
        down = plus & horizontal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | (~(vertical | up) & full)
        minus = up & vertical
        if score < best:
            best, end = score, j
    return best, end


def places(starts: list[int], size: int, m: int, k: int):
    """Runs (from, to) of a text of ``size`` words that hold the estimated starts of an item
    of ``m`` words, each with room for k edits; starts that lie close share a run."""
    i = 0
    while i < len(starts):
        first = last = starts[i]
        while i < len(starts) and starts[i] - last <= 2 * k + m:
            last = starts[i]
            i += 1
        yield max(0, first - k), min(size, last + m + k)


def symbol_masks(sequence: np.ndarray) -> dict[int, int]:
    """For each word of an item, the bit vector of its positions."""
    masks: dict[int, int] = {}
    for j, w in enumerate(sequence.tolist()):
        masks[w] = masks.get(w, 0) | 1 << j
    return masks


def _sequences(batches):
    """(columns..., text) -> (columns..., words): rows with words only, a hash a word."""
    for batch in batches:
        rows, seqs = [], []
        for first, h, off in words(batch.column(batch.num_columns - 1)):
            for i in np.flatnonzero(np.diff(off)).tolist():
                rows.append(first + i)
                seqs.append(h[off[i]:off[i + 1]].tobytes())
        kept = batch.select(batch.schema.names[:-1]).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(seqs, pa.binary())], [*kept.schema.names, "words"])


def _pieces(num: int, den: int):
    def run(batches):
        for batch in batches:
            row, width, key, at = [], [], [], []
            for i, b in enumerate(batch.column("words").to_pylist()):
                s = np.frombuffer(b, np.uint64)
                for a, w in pieces(len(s), budget(len(s), num, den)):
                    row.append(i)
                    width.append(w)
                    at.append(a)
                    key.append(rolling(s[a:a + w], w)[0])
            kept = batch.select(SEQUENCE).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(width, pa.int32()), pa.array(np.array(key, np.uint64).view(np.int64)),
                 pa.array(at, pa.int64())], [*SEQUENCE, "width", "piece", "at"])
    return run


def _piece_bits(found: DataFrame) -> tuple[np.ndarray, list[int]]:
    """A bitmap of the piece hashes (16 MB at most) and the widths of the pieces."""
    n, widths = found.agg(F.count("*"), F.collect_set("width")).first()
    power = min(max(math.ceil(math.log2(16 * n + 1)), BITS[0]), BITS[1]) - 6
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("piece").bitwiseAND(F.lit(63)).cast("int"))
    packed = (found.groupBy(F.shiftrightunsigned("piece", 64 - power).alias("w"))
              .agg(F.bit_or(bit).alias("bits")).toArrow())
    bits = np.zeros(1 << power, np.uint64)
    bits[packed.column("w").to_numpy()] = packed.column("bits").to_numpy().view(np.uint64)
    return bits, sorted(widths)


def _hits(shared):
    """(text key, text) -> (text key, width, piece, pos) of every run that may be a piece."""
    def run(batches):
        bits, widths = shared.value
        shift = np.uint64(64 - (len(bits).bit_length() - 1))
        for batch in batches:
            keys = batch.select(TEXT)
            for first, h, off in words(batch.column("text")):
                for width in widths:
                    runs = rolling(h, width)
                    pos = np.flatnonzero(bits[(runs >> shift).astype(np.int64)] >> (runs & np.uint64(63)) & np.uint64(1))
                    row = np.searchsorted(off, pos, side="right") - 1
                    inside = pos + width <= off[row + 1]
                    pos, row = pos[inside], row[inside]
                    if len(pos):
                        own = keys.take(pa.array(first + row))
                        yield pa.RecordBatch.from_arrays(
                            [*own.columns, pa.array(np.full(len(pos), width, np.int32)),
                             pa.array(runs[pos].view(np.int64)), pa.array(pos - off[row])],
                            [*TEXT, "width", "piece", "pos"])
    return run


def _verified(num: int, den: int):
    """(text key, words, candidates) -> (text key, sequence key, distance, start, stop)."""
    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for i in range(len(batch)):
                h = np.frombuffer(batch.column("words")[i].as_buffer(), np.uint64)
                key = [batch.column(c)[i].as_py() for c in TEXT]
                for c in batch.column("candidates")[i].values.to_pylist():
                    item = np.frombuffer(c["words"], np.uint64)
                    m, k, masks = len(item), budget(len(item), num, den), symbol_masks(item)
                    for lo, hi in places(c["starts"], len(h), m, k):
                        best, end = myers(masks, m, h[lo:hi].tolist())
                        if best <= k:
                            row = (*key, c["s1"], c["s2"], best, max(lo, lo + end - m), lo + end)
                            for column, value in zip(out, row):
                                column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int32() if j == 4 else pa.int64()) for j, column in enumerate(out)],
                [*TEXT, *SEQUENCE, "distance", "start", "stop"])
    return run


def _key(column: Column, names: list[str]) -> list[Column]:
    key = wide_key(column)
    return [key.getField(f"h{seed}").alias(name) for seed, name in zip((1, 2), names)]


def text_key(docs: DataFrame, text_col: str) -> list[Column]:
    return _key(F.col(text_col).cast("string"), TEXT)


def text_matches(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                 item_text: str = "text", num: int = 75, den: int = 100, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(t1, t2, item, distance, start, stop) for every match of a text; t1 and t2 are the
    text's key (``text_key``), so a text that many documents repeat is here once."""
    sc = docs.sparkSession.sparkContext
    id_type = items.schema[item_id].dataType.simpleString()
    named = items.select(F.col(item_id).alias("item"), F.col(item_text).cast("string").alias("text"))
    named = materialize(named.mapInArrow(_sequences, f"item {id_type}, words binary")
                        .select("item", *_key(F.col("words"), SEQUENCE), "words"), "test-items")
    sequences = named.select(*SEQUENCE, "words").dropDuplicates(SEQUENCE)
    found = materialize(sequences.mapInArrow(_pieces(num, den), "s1 long, s2 long, width int, piece long, at long"),
                        "test-pieces")

    texts = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null")
    texts = texts.select(*text_key(texts, "text"), "text")
    hits = texts.mapInArrow(trimmed(_hits(sc.broadcast(_piece_bits(found)))),
                            "t1 long, t2 long, width int, piece long, pos long")
    places_of = (hits.join(found, ["width", "piece"]).groupBy(*TEXT, *SEQUENCE)
                 .agg(F.sort_array(F.collect_set(F.col("pos") - F.col("at"))).alias("starts")))
    candidates = materialize(places_of, "test-candidates").join(sequences, SEQUENCE)

    wanted = candidates.groupBy(*TEXT).agg(
        F.ceil(F.sum(F.length("words") / 8) / block_words).cast("long").alias("blocks"))
    packed = (candidates.join(wanted, TEXT).groupBy(*TEXT, F.pmod(F.xxhash64(*SEQUENCE), "blocks").alias("block"))
              .agg(F.collect_list(F.struct(*SEQUENCE, "words", "starts")).alias("candidates")))
    named_texts = maybe(texts, bitmap(candidates, "t1"), F.col("t1"), "wanted").where("wanted")
    bodies = (named_texts.select(*TEXT, "text").mapInArrow(trimmed(_sequences), "t1 long, t2 long, words binary")
              .dropDuplicates(TEXT))
    verified = packed.join(bodies, TEXT).select(*TEXT, "words", "candidates").mapInArrow(
        trimmed(_verified(num, den)), "t1 long, t2 long, s1 long, s2 long, distance int, start long, stop long")
    return (materialize(verified, "test-matches").join(named.drop("words"), SEQUENCE)
            .select(*TEXT, "item", "distance", "start", "stop"))


def _keyed(docs: DataFrame, text_col: str) -> tuple[DataFrame, list[str]]:
    names = [fresh(docs, f"_{n}") for n in TEXT]
    return docs.select("*", *(c.alias(n) for c, n in zip(text_key(docs, text_col), names))), names


def with_matches(docs: DataFrame, items: DataFrame, out: str = "matches", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with an array column of (item, distance, start, stop), words counted from
    0; empty if the document is clean."""
    found = text_matches(docs, items, text_col, **options)
    whole = F.sort_array(F.collect_list(F.struct("item", "distance", "start", "stop")))
    keyed, names = _keyed(docs, text_col)
    held = fresh(keyed, "_held")
    own = found.groupBy(*(F.col(c).alias(n) for c, n in zip(TEXT, names))).agg(whole.alias(held))
    none = F.array().cast(own.schema[held].dataType)
    return keyed.join(own, names, "left").withColumn(out, F.coalesce(held, none)).drop(*names, held)


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that hold no test item, with their own columns."""
    found = text_matches(docs, items, text_col, **options).select(*TEXT).distinct()
    found = materialize(found, "test-texts")
    keyed, names = _keyed(docs, text_col)
    flag = fresh(keyed, "_maybe")
    keyed = maybe(keyed, bitmap(found, "t1"), F.col(names[0]), flag)
    held = found.select(*(F.col(c).alias(n) for c, n in zip(TEXT, names)))
    rest = keyed.where(F.col(flag)).join(held, names, "left_anti")
    return keyed.where(~F.col(flag)).unionByName(rest).drop(*names, flag)


def op6_decontamination(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = text_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return (docs.select("doc_id", *text_key(docs, "text")).join(found, TEXT)
            .select("doc_id", F.col("item").alias("item_id"), "distance", F.col("start").alias("start_word"),
                    F.col("stop").alias("stop_word")))
