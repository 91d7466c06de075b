"""Line de-duplication over levelled sorted runs of line hashes (operator 13).

A line's key is the line without white space at its ends, A-Z lower-cased.  Keys of at
least ``min_chars`` code points that occur in at least ``min_docs`` documents lose all
their lines except those of the largest id that holds them.

What is known of the keys lies in runs: (h, docs, top) rows, i.e. key hash, number of
documents and largest id, in ``buckets`` by hash and sorted inside a bucket.  Documents
come in batches, the largest ids first.  A batch's keys are counted (map-side first, so a
line of a third of all documents is one row a task) and written in the runs' buckets, then
merge-anti-joined with the settled keys of every run: a key with enough documents and an id above the batch's has
nothing to learn from it.  What remains becomes a run of level 0; ``fanout`` runs of one
level are compacted into one of the next, so an entry is rewritten once a level, and
there are at most ``fanout`` runs of each of log(batches) levels to join.  All runs share
their buckets, so adding a batch moves only its own keys, once, and never a run.

At the end one merge of the runs gives the repeated keys.  Lines meet them by hash.  Keys
that fill over 1 / 512 of a bounded sample of lines (``SAMPLE``; at most 512 such keys)
are broadcast instead, so no hot line lands in one task; the sample decides only the way,
never the result.  The texts move once, to meet the numbers of the lines they lose.

Key hashes and text digests are 128 bits of sha256.  All state is written tables in the
shared folder: a lost executor costs its tasks, and a run that is written stays.

Defined results: a null or empty text is one empty line and stays empty; a document is a
row, so repeated rows count as documents each and keep or lose the same lines; a null id
is below every other (rows without id keep a line only if no id holds it); rows that
share the largest id all keep the line; a line of any length and a text of any number of
lines are handled whole; other columns pass through, and the columns added take names
that are free; an empty table gives an empty table.
"""
from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..plans.order import plan_bytes
from ..session import scratch_path
from .common import fresh, materialize

MIN_CHARS, MIN_DOCS = 40, 5
BATCHES, FANOUT = 8, 4
BUCKET_BYTES = 64 << 20  # of all lines' keys, for each bucket of a run
SAMPLE = 1 << 18  # lines at most that decide which keys are hot
HOT = 512
WHITE = b" \t\n\x0b\x0c\r"

_KEYS = "id {}, t binary, h binary, at array<int>"


def _line_keys(min_chars: int, id_type: pa.DataType):
    def keys_of(text: bytes) -> dict[bytes, list[int]]:
        found: dict[bytes, list[int]] = {}
        for n, line in enumerate(text.split(b"\n") if len(text) >= min_chars else ()):
            key = line.strip(WHITE)
            if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
                found.setdefault(hashlib.sha256(key.lower()).digest()[:16], []).append(n)
        return found

    def table(rows: list[tuple]) -> pa.RecordBatch:
        ids, digests, found = zip(*rows) if rows else ((), (), ())
        per = [len(f) for f in found]
        spread = lambda values: [v for v, n in zip(values, per) for _ in range(n)]
        return pa.RecordBatch.from_arrays(
            [pa.array(spread(ids), id_type), pa.array(spread(digests), pa.binary()),
             pa.array([h for f in found for h in f], pa.binary()),
             pa.array([at for f in found for at in f.values()], pa.list_(pa.int32()))], ["id", "t", "h", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for i, text in zip(batch.column(0), batch.column(1)):  # one text at a time
                text = text.as_py()
                found = keys_of(text)
                if found:
                    rows.append((i.as_py(), hashlib.sha256(text).digest()[:16], found))
                    held += len(found)
                if held >= 1 << 16:
                    yield table(rows)
                    rows, held = [], 0
            yield table(rows)
    return run


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, t, h, at): for every row its keys, with the numbers of their lines (from 0)."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    id_type = rows.schema["id"].dataType
    return rows.mapInArrow(_line_keys(min_chars, to_arrow_type(id_type)), _KEYS.format(id_type.simpleString()))


class LineRuns:
    """Levelled runs of (h, docs, top), each a bucketed and sorted table in the shared folder."""

    def __init__(self, spark: SparkSession, buckets: int, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.buckets, self.min_docs, self.fanout = spark, buckets, min_docs, fanout
        self.levels: list[list[tuple[str, str]]] = []  # table name, path

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        name = f"line_run_{uuid.uuid4().hex[:16]}"
        path = scratch_path(self.spark, name)
        (rows.select("h", "docs", "top").write.format("parquet").bucketBy(self.buckets, "h").sortBy("h")
         .option("path", path).saveAsTable(name))
        return name, path

    def _forget(self, *runs: tuple[str, str]) -> None:
        for name, _ in runs:  # the catalogue entry; files stay till the folder goes
            self.spark.sql(f"DROP TABLE {name}")

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def unsettled(self, batch: DataFrame) -> DataFrame:
        """Merge anti-join of a batch's table with the settled keys of every run."""
        for run in self.runs():
            settled = run.where(F.col("docs") >= self.min_docs).select(F.col("h").alias("h2"), F.col("top").alias("known"))
            batch = batch.join(settled.hint("merge"), F.expr("h = h2 AND top <= known"), "left_anti")
        return batch

    def add(self, keys: DataFrame) -> None:
        """Adds a batch of (id, h) rows, one for each document and key."""
        new = self._write(keys.groupBy("h").agg(F.count("*").alias("docs"), F.max("id").alias("top")))
        if self.levels:
            batch, new = new, self._write(self.unsettled(self.spark.table(new[0])))
            self._forget(batch)
        level = 0
        while True:
            if len(self.levels) == level:
                self.levels.append([])
            self.levels[level].append(new)
            if len(self.levels[level]) < self.fanout:
                return
            new = self._write(self._merged(self.levels[level]))
            self._forget(*self.levels[level])
            self.levels[level], level = [], level + 1

    def _merged(self, runs: list[tuple[str, str]]) -> DataFrame:
        # read as plain files: Spark 4.1 takes a union of bucketed scans for bucketed and
        # then groups some keys twice
        rows = self.spark.read.parquet(*(path for _, path in runs))
        return rows.groupBy("h").agg(F.sum("docs").alias("docs"), F.max("top").alias("top"))

    def repeated(self) -> DataFrame:
        """(h, top) of the keys with at least ``min_docs`` documents."""
        return self._merged([run for level in self.levels for run in level]).where(F.col("docs") >= self.min_docs).select("h", "top")


def _losses(keys: DataFrame, repeated: DataFrame, total: int) -> DataFrame:
    """(id, t, lost): numbers of the lines that a document loses."""
    share = min(1.0, SAMPLE / max(total, 1))
    seen = keys.sample(fraction=share, seed=13) if share < 1 else keys
    often = seen.groupBy("h").count().where(F.col("count") > max(total * share / HOT, 16))
    hot = materialize(repeated.join(often.select("h"), "h"), "line-hot")  # at most HOT rows, but for chance
    rest = repeated.join(F.broadcast(hot.select("h")), "h", "left_anti")
    lines = keys.join(F.broadcast(hot.withColumnRenamed("top", "hot")), "h", "left")
    loses = lambda top: F.col("id").isNull() & F.col(top).isNotNull() | (F.col("id") < F.col(top))
    by_hot = lines.where(F.col("hot").isNotNull() & loses("hot")).select("id", "t", "at")
    by_rest = lines.where("hot is null").join(rest, "h").where(loses("top")).select("id", "t", "at")
    return by_hot.unionByName(by_rest).groupBy("id", "t").agg(F.flatten(F.collect_set("at")).alias("lost"))


@F.arrow_udf(T.StringType())
def _kept(text: pa.Array, lost: pa.Array) -> pa.Array:
    out = []
    for body, gone in zip(text, lost):
        if gone.is_valid:
            gone = set(gone.as_py())
            out.append("\n".join(line for n, line in enumerate(body.as_py().split("\n")) if n not in gone))
        else:
            out.append(body)
    return pa.array([x if isinstance(x, str) else x.as_py() for x in out], pa.string())


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT,
                buckets: int | None = None) -> DataFrame:
    """``docs`` with the kept lines as text, and (n_lines, n_dropped) long under free names."""
    spark = docs.sparkSession
    ids = F.col("id")
    keys = line_keys(docs, id_col, text_col, min_chars)
    numbers = docs.select(F.col(id_col).alias("id"))
    if isinstance(numbers.schema["id"].dataType, T.NumericType):
        cuts = numbers.agg(F.percentile_approx("id", [i / batches for i in range(1, batches)], 1_000)).first()[0] or []
        cuts = sorted(set(cuts))
        batch = F.lit(len(cuts)).cast("int")  # 0: the largest ids; rows without id come last
        for i, cut in enumerate(cuts):
            batch = F.when(ids > F.lit(cut), F.lit(len(cuts) - 1 - i)).otherwise(batch)
    else:  # the order of the batches only saves work
        batch = F.pmod(F.xxhash64(ids), F.lit(batches)).cast("int")
    keys = keys.withColumn("batch", batch)
    path = scratch_path(spark, "line-keys")
    keys.write.partitionBy("batch").parquet(path)
    keys = spark.read.schema(keys.schema).parquet(path)
    sizes = {r["batch"]: r["count"] for r in keys.groupBy("batch").count().collect()}
    total = sum(sizes.values())
    runs = LineRuns(spark, buckets or max(8, -(-(plan_bytes(keys) or 0) // BUCKET_BYTES)), min_docs, fanout)
    for b in sorted(sizes):
        runs.add(keys.where(F.col("batch") == b).select("id", "h"))
    n_lines, n_dropped = fresh(docs, "n_lines"), fresh(docs, "n_dropped")
    t, lost, i2, t2 = (fresh(docs, c) for c in ("_t", "_lost", "_id2", "_t2"))
    out = docs.withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))
    if sizes:
        repeated = materialize(runs.repeated(), "line-repeated")
        losses = _losses(keys.select("id", "t", "h", "at"), repeated, total).toDF(i2, t2, lost)
        out = out.withColumn(t, F.substring(F.unhex(F.sha2(F.col(text_col).cast("binary"), 256)), 1, 16))
        out = out.join(losses, F.col(id_col).eqNullSafe(F.col(i2)) & (F.col(t) == F.col(t2)), "left").drop(t, i2, t2)
    else:
        out = out.withColumn(lost, F.lit(None).cast("array<int>"))
    text = F.col(text_col)
    out = out.withColumn(n_lines, (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long"))
    out = out.withColumn(n_dropped, F.coalesce(F.size(lost), F.lit(0)).cast("long"))
    return out.withColumn(text_col, _kept(text, F.col(lost))).drop(lost)


def op13_line_runs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped",
                                    F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
s AS (SELECT r, doc_id, string_split(text, chr(10)) AS lines FROM d),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS n FROM s),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, count(DISTINCT r) AS docs, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key),
m AS (SELECT k.*, coalesce(f.docs >= 5 AND f.top IS NOT NULL AND (k.doc_id IS NULL OR k.doc_id < f.top), false) AS gone
FROM k LEFT JOIN f ON f.key = k.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY r"""
