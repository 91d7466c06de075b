"""Edit-aware token counts (operator 5).

A document is kept as a segment tree over runs of pre-tokens.  Runs are cut at a single
space between two non-space characters: the tokenizer's pattern always starts a pre-token
there, and byte-pair merges never cross pre-tokens, so the counts of the runs add up to
the count of the text.  Leaves hold a run's characters and tokens, inner nodes the sums.

An edit (position, characters to delete, text to insert; positions in the text as the edits
before it left it) is found by descending the character sums.  The leaves it touches are
joined, with the neighbour on a side where the edit reaches the two characters that make
that cut safe; only this region is encoded again, and the sums above its leaves change.

Trees are columns (``run_chars``, ``run_tokens``: the leaves; ``n_tokens``: the root), so they
can be stored with the text and edited later without encoding the text again.

Defined results: null text is kept as null with no runs and 0 tokens, an edit of it inserts
into an empty text; positions and lengths beyond the text are cut to it, negative ones are
0; null parts of an edit are 0 or empty, a null list is no edit; repeated rows are separate;
an empty table gives an empty result; other columns pass through, one with a name that the
operator gives (in any case of letters) under the next free name with ``_`` in front.
"""
from __future__ import annotations

import base64
import functools
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh

RUN = 256  # characters of a run at least, up to the next safe cut
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the pre-token pattern of the vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
EDITS = "array<struct<pos:int,del:int,ins:string>>"

_SAFE = re.compile(r"(?<=\S) (?=\S)")


@functools.lru_cache(maxsize=2)
def _encoding(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("runs", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def counter(vocabulary: bytes):
    encode = _encoding(vocabulary).encode_ordinary
    return lambda text: len(encode(text)) if text else 0


def cut(text: str, run: int = RUN) -> list[str]:
    """Runs of at least ``run`` characters that end at safe cuts."""
    out, at = [], 0
    while len(text) - at > run:
        m = _SAFE.search(text, at + run)
        if not m:
            break
        out.append(text[at:m.start()])
        at = m.start()
    if at < len(text):
        out.append(text[at:])
    return out


class SegmentTree:
    """Character and token sums over the runs of one text."""

    def __init__(self, runs: list[str], tokens: list[int], count, run: int = RUN):
        self.count, self.run, self.encoded_runs, self.encoded_chars = count, run, 0, 0
        self._build(runs, tokens)

    def _build(self, runs: list[str], tokens: list[int]) -> None:
        self.runs = runs
        self.size = 1
        while self.size < max(1, len(runs)):
            self.size *= 2
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, (r, t) in enumerate(zip(runs, tokens)):
            self.chars[self.size + i], self.tokens[self.size + i] = len(r), t
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def leaf_at(self, pos: int) -> tuple[int, int]:
        """(leaf, characters before it) that holds the character at ``pos``."""
        i, before = 1, 0
        while i < self.size:
            i *= 2
            if pos >= before + self.chars[i] and self.chars[i + 1]:
                before += self.chars[i]
                i += 1
        return i - self.size, before

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.runs[leaf] = text
        i = self.size + leaf
        self.chars[i], self.tokens[i] = len(text), tokens
        while i > 1:
            i //= 2
            self._sum(i)

    def edit(self, pos: int | None, delete: int | None, insert: str | None) -> None:
        pos = min(max(pos or 0, 0), self.n_chars)
        end = min(pos + max(delete or 0, 0), self.n_chars)
        insert = insert or ""
        if end == pos and not insert:
            return
        if not self.runs:
            self._replace(0, 0, insert)
            return
        first, start = self.leaf_at(max(pos - 1, 0))
        last, before = self.leaf_at(min(end, self.n_chars - 1))
        # the cut before a run is safe while the character before it, the space and the
        # character after it stay: take the neighbour in where the edit reaches them
        while first > 0 and pos - start < 2:
            first -= 1
            start -= len(self.runs[first])
        while last < len(self.runs) - 1 and before + len(self.runs[last]) - end < 2:
            before += len(self.runs[last])
            last += 1
        text = "".join(self.runs[first:last + 1])
        self._replace(first, last + 1, text[:pos - start] + insert + text[end - start:])

    def _replace(self, lo: int, hi: int, text: str) -> None:
        new = cut(text, self.run) if len(text) > 4 * self.run else [text] if text else []
        tokens = [self.count(r) for r in new]
        self.encoded_runs += len(new)
        self.encoded_chars += len(text)
        if len(new) <= hi - lo:
            for i in range(lo, hi):  # emptied leaves keep their place
                k = i - lo
                self._set(i, new[k] if k < len(new) else "", tokens[k] if k < len(new) else 0)
        else:  # a longer row of leaves: sums are built again, nothing else is encoded
            leaves = self.tokens[self.size:self.size + len(self.runs)]
            self._build(self.runs[:lo] + new + self.runs[hi:], leaves[:lo] + tokens + leaves[hi:])

    def leaves(self) -> tuple[list[int], list[int]]:
        n = len(self.runs)
        kept = [i for i in range(n) if self.runs[i]]
        return [len(self.runs[i]) for i in kept], [self.tokens[self.size + i] for i in kept]

    def text(self) -> str:
        return "".join(self.runs)


TREE = [("run_chars", "array<int>", pa.list_(pa.int32())), ("run_tokens", "array<int>", pa.list_(pa.int32())),
        ("n_tokens", "bigint", pa.int64())]


def vocabulary_bytes(spark: SparkSession, path: str = VOCABULARY):
    """The vocabulary file, read by Spark and sent to every task (under 1 MB)."""
    rows = spark.read.format("binaryFile").load(path if "://" in path else f"file://{path}").select("content").head(1)
    return spark.sparkContext.broadcast(bytes(rows[0]["content"]))


def _aside(df: DataFrame, names: list[str], used: list[str]) -> DataFrame:
    """``df`` with columns called like one of ``names`` under a free name."""
    taken = {n.lower() for n in names}
    for c in used:
        if c.lower() in taken:
            raise ValueError(f"column {c} has the name of a result")
    for c in df.columns:
        if c.lower() in taken:
            df = df.withColumnRenamed(c, fresh(df, f"_{c}"))
    return df


def build_trees(docs: DataFrame, vocabulary, text_col: str = "text", run: int = RUN) -> DataFrame:
    """``docs`` with its trees; ``vocabulary``: what ``vocabulary_bytes`` gives."""
    docs = _aside(docs, [n for n, _, _ in TREE], [text_col])
    schema = T.StructType(docs.schema.fields + [T.StructField(n, T._parse_datatype_string(t)) for n, t, _ in TREE])

    def build(batches):
        count = counter(vocabulary.value)
        for batch in batches:
            chars, tokens = [], []
            for t in batch.column(text_col):
                runs = cut(t.as_py() or "", run)
                chars.append([len(r) for r in runs])
                tokens.append([count(r) for r in runs])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(chars, TREE[0][2]), pa.array(tokens, TREE[1][2]),
                 pa.array([sum(x) for x in tokens], TREE[2][2])], [*batch.schema.names, *(n for n, _, _ in TREE)])

    return docs.mapInArrow(build, schema)


CHANGES = [("edited_tokens", "bigint"), ("encoded_runs", "bigint"), ("encoded_chars", "bigint"), ("edited_chars", "bigint")]


def apply_edits(trees: DataFrame, vocabulary, edits_col: str = "edits", text_col: str = "text", run: int = RUN,
                keep_text: bool = True) -> DataFrame:
    """Apply each row's edits in order: text and tree columns become those of the edited
    text; ``edited_tokens`` is its count, ``encoded_*`` what had to be encoded again."""
    trees = _aside(trees, [n for n, _ in CHANGES], [text_col, edits_col])
    fields = [f for f in trees.schema.fields if f.name != edits_col and (keep_text or f.name not in (
        text_col, "run_chars", "run_tokens"))]
    schema = T.StructType(fields + [T.StructField(n, T._parse_datatype_string(t)) for n, t in CHANGES])

    def run_edits(batches):
        count = counter(vocabulary.value)
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            out = {n: [] for n in (text_col, "run_chars", "run_tokens", *(n for n, _ in CHANGES))}
            for text, chars, tokens, edits in zip(*(batch.column(at[c]) for c in (text_col, "run_chars", "run_tokens", edits_col))):
                text, runs, pos = text.as_py() or "", [], 0
                for n in chars.as_py() or []:
                    runs.append(text[pos:pos + n])
                    pos += n
                tree = SegmentTree(runs, tokens.as_py() or [], count, run)
                for e in edits.as_py() or []:
                    if e is not None:
                        tree.edit(e["pos"], e["del"], e["ins"])
                if keep_text:
                    c, t = tree.leaves()
                    for name, v in ((text_col, tree.text()), ("run_chars", c), ("run_tokens", t)):
                        out[name].append(v)
                for (name, _), v in zip(CHANGES, (tree.n_tokens, tree.encoded_runs, tree.encoded_chars, tree.n_chars)):
                    out[name].append(v)
            kinds = {text_col: pa.string(), "run_chars": TREE[0][2], "run_tokens": TREE[1][2]}
            cols = [pa.array(out[f.name], kinds[f.name]) if f.name in kinds else batch.column(at[f.name]) for f in fields]
            yield pa.RecordBatch.from_arrays([*cols, *(pa.array(out[n], pa.int64()) for n, _ in CHANGES)], schema.names)

    return trees.mapInArrow(run_edits, schema)


def derived_edits(key: Column, text: Column) -> Column:
    """Three edits of a text that depend on it and its key alone: a passage of its own
    pasted elsewhere, a deletion and a replacement."""
    n = F.coalesce(F.char_length(text), F.lit(0))
    place = lambda i: F.pmod(F.xxhash64(F.lit(i), key), n + 1).cast("int")
    edit = lambda pos, size, ins: F.struct(pos.alias("pos"), F.lit(size).alias("del"), ins.alias("ins"))
    return F.array(edit(place(1), 0, F.coalesce(F.substr(text, place(2) + 1, F.lit(24)), F.lit(""))),
                   edit(place(3), 30, F.lit("")),
                   edit(place(4), 12, F.lit(" edited 2024, "))).cast(EDITS)


def op5_edit_aware_counts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    vocabulary = vocabulary_bytes(spark)
    docs = docs.withColumn("edits", derived_edits(F.col("doc_id"), F.col("text")))
    trees = build_trees(docs, vocabulary).withColumn("n_runs", F.size("run_chars").cast("long"))
    return apply_edits(trees, vocabulary, keep_text=False)
