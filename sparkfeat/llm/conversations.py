"""Conversation structure repair by Four-Russians block tables (operator 12).

Rows of a conversation, by turn, are edited so that the initials of the roles read
``(s?(ua)+)?``: Keep costs 0, Rerole (to user or assistant) 2, Delete 3, Insert (an empty
user or assistant row, anywhere) 2; a truncated row that stays adds 1; blank rows and
duplicates must go.  Of the cheapest edits those with the least string of initials are
taken.

A row is one of nine symbols (initial s, u, a, other, whole or truncated; or "must go"),
and what the rest of a conversation costs is a vector over the four states of the
pattern.  Less its minimum such a vector takes few values, so all of them are numbered,
and for each vector and each block of ``BLOCK`` symbols the vector before the block and
the cost are looked up in one table, built from the single steps.  A conversation is
solved from its end, a lookup a block.  Tracing goes forward: a block is expanded backward
from the vector behind it, then takes the least letter that is still optimal, so ties are
settled exactly; expansions are kept and used again.

In Spark: rows are range-partitioned by (conversation, turn) once, so a conversation with
a third of all rows is spread over many tasks.  Its symbols are cut into chunks of
``CHUNK`` rows, a task each.  A conversation of several chunks takes four passes over
them: each chunk's cost from state to state (16 numbers), a scan over a conversation's
chunks for the vectors behind them, each chunk's end state by start state, a scan for the
start states.  All others need none of it.  The texts then move once, to be written out in
order; one task streams a conversation (a hash of the whole can't be taken in parts) and
holds one Arrow batch and the conversation's letters.

Defined results: a null role or text is one space, a null turn comes first and plays no
part in gaps, a null conversation id is a conversation; rows of one turn go by a digest of
role and text; every row counts, repeated ones as duplicates; an empty role has no
initial; a conversation without rows has cost 0, no edits and no text; further columns
are left out; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..plans.order import index_buckets, null_safe_join
from .common import fresh, materialize, parts_for
from .merkle import crc32_sql

BLOCK = 4  # symbols of a table block
CHUNK = 1 << 14  # rows of a task's piece of a conversation
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
SYMBOLS, GONE = 9, 8
NEVER = 1 << 12  # more than any difference between two states
# states: 0 nothing yet, 1 after s, 2 after u, 3 after a; what a user or assistant row leads to
NEXT = (2, 2, 3, 2)
KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}  # (state, initial s u a) -> state
WHITE = " \t\n\x0b\x0c\r"


def _closed(cost: list[int]) -> list[int]:
    """Costs when rows may be inserted first."""
    for _ in range(3):
        cost = [min(cost[q], INSERT + cost[NEXT[q]], NEVER) for q in range(4)]
    return cost


def _before(after, x: int) -> list[int]:
    """Costs to go before a row of symbol ``x``."""
    cost = [DELETE + after[q] for q in range(4)]
    if x != GONE:
        late = TRUNCATED if x >= 4 else 0
        for q in range(4):
            cost[q] = min(cost[q], REROLE + late + after[NEXT[q]])
            if (q, x % 4) in KEPT:
                cost[q] = min(cost[q], KEEP + late + after[KEPT[q, x % 4]])
    return _closed(cost)


def normal(cost) -> tuple[tuple[int, ...], int]:
    low = min(cost)
    return tuple(c if c >= NEVER else c - low for c in cost), low


class Tables:
    """All normalised cost vectors, the single steps and the block table over them."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.end = tuple(_closed([0, NEVER, NEVER, 0]))
        units = [tuple(0 if q == p else NEVER for p in range(4)) for q in range(4)]
        self.vectors, self.number, steps = [], {}, []
        for v in [self.end, *units]:
            self._add(v)
        at = 0
        while at < len(self.vectors):
            row = []
            for x in range(SYMBOLS):
                v, low = normal(_before(self.vectors[at], x))
                row.append((self._add(v), low))
            steps.append(row)
            at += 1
        self.steps = steps
        to, add = (np.array([[s[i] for s in row] for row in steps], np.int32) for i in (0, 1))
        self.to, self.add = to, add
        front = np.arange(SYMBOLS)[None, :, None]
        for _ in range(block - 1):  # one more symbol in front
            v = to[:, None, :]
            add = (add[:, None, :] + self.add[v, front]).reshape(len(to), -1)
            to = self.to[v, front].reshape(len(to), -1)
        self.block_to, self.block_add = to, add
        self.weights = SYMBOLS ** np.arange(block - 1, -1, -1)

    def _add(self, v: tuple[int, ...]) -> int:
        if v not in self.number:
            self.number[v] = len(self.vectors)
            self.vectors.append(v)
        return self.number[v]

    def codes(self, symbols: np.ndarray) -> tuple[list[int], list[int]]:
        """Block codes, and the symbols left over at the end."""
        whole = len(symbols) // self.block * self.block
        return ((symbols[:whole].reshape(-1, self.block).astype(np.int64) @ self.weights).tolist(), symbols[whole:].tolist())

    def behind(self, symbols: np.ndarray, end: int) -> tuple[list[int], int, int]:
        """Vector behind each block (the symbols left over as one more), the vector before all
        of them, and what lies between its minimum and that of ``end``."""
        codes, rest = self.codes(symbols)
        v, cost, at = end, 0, [end]
        for x in reversed(rest):
            cost += int(self.add[v, x])
            v = int(self.to[v, x])
        for code in reversed(codes):
            at.append(v)
            cost += int(self.block_add[v, code])
            v = int(self.block_to[v, code])
        return at[::-1], v, cost

    @lru_cache(maxsize=1 << 16)
    def expand(self, v: int, symbols: tuple[int, ...], state: int) -> tuple[str, int]:
        """Least optimal letters of a block from ``state``, with vector ``v`` behind it, and the
        state that they lead to."""
        at = [v]
        for x in reversed(symbols):
            at.append(self.steps[at[-1]][x][0])
        at = at[::-1]
        letters = []
        for j, x in enumerate(symbols):
            after, low = self.vectors[at[j + 1]], self.steps[at[j + 1]][x][1]
            here = self.vectors[at[j]]
            late = TRUNCATED if x >= 4 else 0
            while True:
                left = here[state] + low
                if DELETE + after[state] == left:
                    letters.append("D")
                    break
                if INSERT + here[NEXT[state]] == here[state]:
                    letters.append("I")
                    state = NEXT[state]
                    continue
                if x != GONE and (state, x % 4) in KEPT and KEEP + late + after[KEPT[state, x % 4]] == left:
                    letters.append("K")
                    state = KEPT[state, x % 4]
                    break
                letters.append("R")
                state = NEXT[state]
                break
        return "".join(letters), state

    def trace(self, symbols: np.ndarray, end: int, state: int, last: bool) -> tuple[str, int]:
        """Letters of a chunk, with the rows inserted behind the last one."""
        at, _, _ = self.behind(symbols, end)
        given, out = symbols.tolist(), []
        for i in range(0, len(given), self.block):
            letters, state = self.expand(at[i // self.block], tuple(given[i:i + self.block]), state)
            out.append(letters)
        while last and state not in (0, 3):
            out.append("I")
            state = NEXT[state]
        return "".join(out), state


@lru_cache(maxsize=None)
def tables() -> Tables:
    return Tables()


def _symbols(codes: list[int]) -> np.ndarray:
    return np.minimum(np.array(codes, np.uint8), GONE)


# ------------------------------------------------------------------ passes over chunks
def _pass(work, columns: dict[str, pa.DataType], conv_type: pa.DataType):
    """mapInArrow over chunks: ``work(row)`` gives the values of ``columns``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            done = [work(r) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["conv"] for r in rows], conv_type), pa.array([r["chunk"] for r in rows], pa.int64()),
                 *(pa.array([d[i] for d in done], t) for i, t in enumerate(columns.values()))], ["conv", "chunk", *columns])
    return run


def _costs(row) -> tuple[list[int]]:
    """A chunk's cost from each state (in fours) by the state behind it."""
    t, out = tables(), []
    for q in range(4):
        _, v, cost = t.behind(_symbols(row["codes"]), 1 + q)
        out += [min(c + cost, NEVER << 40) if c < NEVER else NEVER << 40 for c in t.vectors[v]]
    return (out,)


def _ends(table: pa.Table) -> pa.Table:
    """Vector behind every chunk of one conversation."""
    t, table = tables(), table.sort_by([("chunk", "descending")])
    v, out = t.end, []
    for costs in table["costs"].to_pylist():
        out.append(t.number[v])
        v, _ = normal([min(c + w for c, w in zip(costs[p::4], v) if w < NEVER) for p in range(4)])
        v = tuple(min(c, NEVER) for c in v)
    return table.select(["conv", "chunk"]).append_column("end", pa.array(out, pa.int32()))


def _moves(row) -> tuple[list[int]]:
    t = tables()
    return ([t.trace(_symbols(row["codes"]), row["end"], q, False)[1] for q in range(4)],)


def _starts(table: pa.Table) -> pa.Table:
    """State before every chunk of one conversation."""
    table, q, out = table.sort_by("chunk"), 0, []
    for to in table["moves"].to_pylist():
        out.append(q)
        q = to[q]
    return table.select(["conv", "chunk"]).append_column("start", pa.array(out, pa.int32()))


def _letters(row) -> tuple[str]:
    return (tables().trace(_symbols(row["codes"]), row["end"], row["start"], row["last"])[0],)


def edits(chunks: DataFrame, chunk_rows: int) -> DataFrame:
    """(conv, chunk, letters) of (conv, chunk, n, codes); n: rows of the conversation."""
    kind = chunks.schema["conv"].dataType
    arrow, ddl = to_arrow_type(kind), f"conv {kind.simpleString()}, chunk long"
    end = F.lit(tables().number[tables().end])
    chunks = chunks.withColumn("last", (F.col("chunk") + 1) * chunk_rows >= F.col("n"))
    ready = chunks.where(F.col("n") <= chunk_rows).select("conv", "chunk", "codes", "last", end.alias("end"), F.lit(0).alias("start"))
    many = chunks.where(F.col("n") > chunk_rows)
    if not many.isEmpty():
        costs = many.select("conv", "chunk", "codes").mapInArrow(
            _pass(_costs, {"costs": pa.list_(pa.int64())}, arrow), f"{ddl}, costs array<long>")
        ends = materialize(costs.groupBy("conv").applyInArrow(_ends, f"{ddl}, end int"), "conv-ends")
        many = materialize(null_safe_join(many.drop("n"), ends, ["conv", "chunk"]), "conv-chunks")
        moves = many.select("conv", "chunk", "codes", "end").mapInArrow(
            _pass(_moves, {"moves": pa.list_(pa.int32())}, arrow), f"{ddl}, moves array<int>")
        starts = materialize(moves.groupBy("conv").applyInArrow(_starts, f"{ddl}, start int"), "conv-starts")
        many = null_safe_join(many, starts, ["conv", "chunk"])
        ready = ready.unionByName(many.select(*ready.columns))
    return ready.mapInArrow(_pass(_letters, {"letters": pa.string()}, arrow), f"{ddl}, letters string")


# ------------------------------------------------------------------ writing out
class _Conversation:
    """What is known of the conversation that a task writes out."""

    def __init__(self, conv, turns: list | None):
        self.conv, self.turns = conv, turns
        self.counts = [0, 0, 0]  # truncated, blank, duplicate
        self.low = self.high = None
        self.different = self.illegal = self.cost = self.n = 0
        self.state, self.initial, self.audit = 0, None, []
        self.codes, self.letters, self.row, self.at = [], "", 0, 0
        self.digest = hashlib.sha256()

    def chunk(self, codes, letters):
        self.flush()
        self.codes, self.letters, self.row, self.at = codes, letters, 0, 0
        self.audit.append(letters)

    def write(self, role: str, text: str):
        self.digest.update((f"\n{role}:{text}" if self.n else f"{role}:{text}").encode())
        if self.turns is not None:
            self.turns.append((self.conv, self.n, role, text))
        self.n += 1

    def flush(self):
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.write("assistant" if self.state == 2 else "user", "")
            self.state, self.cost, self.at = NEXT[self.state], self.cost + INSERT, self.at + 1

    def add(self, turn, role: str, text: str):
        code = self.codes[self.row]
        self.row += 1
        fault, initial = code // 4, code % 4
        if fault:
            self.counts[fault - 1] += 1
        if turn is not None:
            self.different += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.initial is not None and (self.initial, initial) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.initial = initial
        self.flush()
        letter, self.at = self.letters[self.at], self.at + 1
        if letter == "D":
            self.cost += DELETE
            return
        self.cost += TRUNCATED * (fault == 1)
        if letter == "K":
            self.write(role, text)
            self.state = KEPT[self.state, initial]
        else:
            self.write("assistant" if self.state == 2 else "user", text)
            self.state, self.cost = NEXT[self.state], self.cost + REROLE

    def report(self) -> tuple:
        self.flush()
        gaps = 0 if self.high is None else self.high - self.low + 1 - self.different
        truncated, blank, duplicate = self.counts
        return (self.conv, gaps, blank, duplicate, truncated, self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _write_out(conv_type: pa.DataType, as_turns: bool):
    if as_turns:
        schema = pa.schema([("conv", conv_type), ("n", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    else:
        schema = pa.schema([("conv", conv_type), *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                            ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def table():
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

        def done():
            report = now.report()
            if not as_turns:
                out.append(report)

        for batch in batches:
            for conv, codes, letters, turn, role, text in zip(*(batch.column(c).to_pylist() for c in (
                    "conv", "codes", "letters", "turn", "role", "text"))):
                if now is None or now.conv != conv:
                    if now is not None:
                        done()
                    now = _Conversation(conv, out if as_turns else None)
                if letters is not None:
                    now.chunk(codes, letters)
                else:
                    now.add(turn, role, text)
            yield table()
            out.clear()
        if now is not None:
            done()
            yield table()
    return run


# ------------------------------------------------------------------ from rows to chunks
def _placed(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, digest, at): rows in order, written once; ``at`` ascends."""
    order = ["conv", "turn", "digest"]
    size = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    rows = rows.withColumn("digest", F.substring(F.unhex(F.sha2(size.cast("binary"), 256)), 1, 16))
    return materialize(rows.repartitionByRange(index_buckets(rows), *order).sortWithinPartitions(*order)
                       .withColumn("at", F.monotonically_increasing_id()), "conv-rows")


def chunks_of(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """(conv, chunk, n, at, codes) of placed rows; a code is 4 * fault + initial, fault 0
    none, 1 truncated, 2 blank, 3 duplicate."""
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    first = F.substring("role", 1, 1)
    slim = rows.select(
        "conv", "digest", "at", F.shiftright("at", 33).alias("part"), (body == "").alias("blank"),
        (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3).alias("initial"))
    twice = slim.groupBy("conv", "digest").agg(F.min("at").alias("first"), F.count("*").alias("k")).where("k > 1").drop("k")
    parts = slim.groupBy("conv", "part").agg(F.min("at").alias("low"), F.count("*").alias("k"))
    over = Window.partitionBy("conv")  # a row a range partition that holds the conversation
    before = F.coalesce(F.sum("k").over(over.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("conv", "part", "low", before.alias("before"), F.sum("k").over(over).alias("n"))
    both = null_safe_join(slim, parts, ["conv", "part"])
    again = twice.select(F.col("conv").alias("conv2"), F.col("digest").alias("digest2"), "first")
    both = both.join(again, both["conv"].eqNullSafe(again["conv2"]) & (both["digest"] == again["digest2"]), "left")
    fault = (F.when(F.col("blank"), 2).when(F.col("at") > F.col("first"), 3).when(F.col("cut"), 1).otherwise(0))
    rn = F.col("before") + F.col("at") - F.col("low")
    coded = both.select("conv", "n", "at", F.floor(rn / chunk_rows).alias("chunk"), (4 * fault + F.col("initial")).cast("tinyint").alias("code"))
    return coded.groupBy("conv", "chunk").agg(
        F.first("n").alias("n"), F.min("at").alias("at"),
        F.transform(F.array_sort(F.collect_list(F.struct("at", "code"))), lambda x: x["code"]).alias("codes"))


def _repair(conversations: DataFrame, conv: str, turn: str, role: str, text: str, chunk_rows: int, as_turns: bool) -> DataFrame:
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = _placed(conversations.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                                        space(role).alias("role"), space(text).alias("text")))
    chunks = materialize(chunks_of(rows, chunk_rows), "conv-codes")
    letters = edits(chunks.select("conv", "chunk", "n", "codes"), chunk_rows)
    none = F.lit(None)
    heads = null_safe_join(chunks.select("conv", "chunk", "at", "codes"), letters, ["conv", "chunk"]).select(
        "conv", "at", F.lit(0).alias("kind"), "codes", "letters", none.cast("long").alias("turn"),
        none.cast("string").alias("role"), none.cast("string").alias("text"))
    rows = rows.select("conv", "at", F.lit(1).alias("kind"), none.cast("array<tinyint>").alias("codes"),
                       none.cast("string").alias("letters"), "turn", "role", "text")
    stream = heads.unionByName(rows).repartition(parts_for(conversations), "conv").sortWithinPartitions("conv", "at", "kind")
    kind = rows.schema["conv"].dataType
    ddl = f"conv {kind.simpleString()}, " + ("n long, role string, text string" if as_turns else _REPORT)
    return stream.mapInArrow(_write_out(to_arrow_type(kind), as_turns), ddl)


def repaired_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text", chunk_rows: int = CHUNK) -> DataFrame:
    """(conv, n, role, text): the repaired conversations, rows numbered from 0."""
    return _repair(conversations, conv, turn, role, text, chunk_rows, True).withColumnRenamed("conv", conv)


def repair_report(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text", chunk_rows: int = CHUNK) -> DataFrame:
    """One row a conversation that has rows: faults, cost, audit, sha256 of the repaired text."""
    return _repair(conversations, conv, turn, role, text, chunk_rows, False).withColumnRenamed("conv", conv)


def damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows dropped, emptied, cut, repeated or reroled by crc32(conv:turn) % 20."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d, copy = fresh(conversations, "_damage"), fresh(conversations, "_copy")
    out = conversations.withColumn(d, F.crc32(F.concat(part(conv), F.lit(":"), part(turn)).cast("binary")) % 20)
    out = out.where(F.col(d) != 0).withColumn(text, F.when(F.col(d) == 1, F.lit("")).when(
        F.col(d) == 2, F.translate(part(text), ".!?", "")).otherwise(part(text)))
    out = out.withColumn(role, F.when(F.col(d) == 4, F.lit("user")).otherwise(part(role)))
    out = out.withColumn(copy, F.explode(F.when(F.col(d) == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return out.drop(d, copy)


def op12_block_repair(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    report = repair_report(damaged(given)).withColumnRenamed("conv_id", "conv")
    every = given.select("conv_id").distinct()
    out = every.join(report, every["conv_id"].eqNullSafe(report["conv"]), "left").drop("conv")
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return out.withColumns(zeros | {"audit": F.coalesce("audit", F.lit("")),
                                    "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))})


ORACLE = f"""WITH RECURSIVE z AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
{crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS z,
dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g FROM conversations),
d AS (SELECT g, turn, CASE WHEN z = 4 THEN 'user' ELSE role END AS role,
CASE WHEN z = 1 THEN '' WHEN z = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
unnest(CASE WHEN z = 3 THEN [0, 1] ELSE [0] END) AS copy FROM z WHERE z <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST,
substr(sha256(octet_length(encode(role)) || ':' || role || text), 1, 32), copy) AS i, count(*) OVER (PARTITION BY g) AS n,
rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, left(role, 1) AS c FROM d),
f AS (SELECT *, CASE WHEN body = '' THEN 2 WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 3
WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault,
coalesce(lag(c) OVER (PARTITION BY g ORDER BY i) || c NOT IN ('su', 'ua', 'au'), false) AS odd FROM o),
p AS (SELECT *, CASE WHEN fault >= 2 THEN 9999 ELSE (fault = 1)::INT END AS t FROM f),
cost AS (SELECT g, n + 1 AS i, [0, 4, 2, 0] AS b FROM p GROUP BY g, n
UNION ALL SELECT g, i, [least(r[1], 2 + r[3], 4 + r[4]), least(r[2], 2 + r[3], 4 + r[4]), least(r[3], 2 + r[4]), least(r[4], 2 + r[3])]
FROM (SELECT p.g, p.i, [least(3 + b[1], 2 + t + b[3], CASE c WHEN 's' THEN t + b[2] WHEN 'u' THEN t + b[3] END),
least(3 + b[2], 2 + t + b[3], CASE c WHEN 'u' THEN t + b[3] END), least(3 + b[3], 2 + t + b[4], CASE c WHEN 'a' THEN t + b[4] END),
least(3 + b[4], 2 + t + b[3], CASE c WHEN 'u' THEN t + b[3] END)] AS r FROM cost JOIN p ON p.g = cost.g AND p.i = cost.i - 1)),
walk AS (SELECT g, 1::BIGINT AS i, 1 AS q, '' AS audit, [''] AS told, 0 AS step FROM cost WHERE i = 1
UNION ALL SELECT g, CASE WHEN e = 'I' THEN i ELSE i + 1 END,
CASE WHEN e = 'D' THEN q WHEN e = 'K' AND q = 1 AND c = 's' THEN 2 WHEN q = 3 THEN 4 ELSE 3 END, audit || e,
CASE e WHEN 'D' THEN told WHEN 'K' THEN list_append(told, role || ':' || text)
ELSE list_append(told, CASE WHEN q = 3 THEN 'assistant:' ELSE 'user:' END || CASE e WHEN 'R' THEN text ELSE '' END) END, step + 1
FROM (SELECT w.*, p.c, p.role, p.text, CASE WHEN a.b IS NULL THEN 'I' WHEN 3 + a.b[q] = h.b[q] THEN 'D'
WHEN 2 + h.b[CASE WHEN q = 3 THEN 4 ELSE 3 END] = h.b[q] THEN 'I'
WHEN (p.c = 's' AND q = 1 AND t + a.b[2] = h.b[1]) OR (p.c = 'u' AND q <> 3 AND t + a.b[3] = h.b[q])
OR (p.c = 'a' AND q = 3 AND t + a.b[4] = h.b[3]) THEN 'K' ELSE 'R' END AS e
FROM walk w JOIN cost h ON h.g = w.g AND h.i = w.i LEFT JOIN cost a ON a.g = w.g AND a.i = w.i + 1
LEFT JOIN p ON p.g = w.g AND p.i = w.i WHERE a.b IS NOT NULL OR q IN (2, 3))),
told AS (SELECT g, arg_max(audit, step) AS audit, array_to_string(arg_max(told, step)[2:], chr(10)) AS repaired FROM walk GROUP BY g),
s AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 2) AS blank,
count(*) FILTER (fault = 3) AS duplicate, count(*) FILTER (fault = 1) AS truncated, count(*) FILTER (odd) AS illegal FROM p GROUP BY g)
SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost.b[1], 0)::BIGINT AS cost,
coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT g, conv_id FROM z) k LEFT JOIN s ON s.g = k.g LEFT JOIN told ON told.g = k.g
LEFT JOIN cost ON cost.g = k.g AND cost.i = 1"""
