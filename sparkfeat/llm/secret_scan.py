"""Secret scan with corpus-wide ownership frequency (operator 4, DataFrame functions only).

Base kinds, leftmost and non-overlapping per kind over the whole text:

* ``assign``  a key word, ``:`` or ``=``, and a value of 6 or more characters;
* ``access``  ``AKIA`` and upper-case letters or digits, 20 or more characters;
* ``hex``     24 or more lower-case hex digits.

The method adds ``token``: 24 or more of ``[A-Za-z0-9+/_-]`` with an upper-case letter, a
lower-case letter and a digit, if owner-specific and outside the base spans.

Every candidate value (the assigned value, the key, the digits, the token) is hashed, and the
hashes are aggregated by distinct repositories and owners over the whole table.  A value that
more than ``max_owners`` owners or more than ``max_repos`` repositories hold is a widely copied
example; one that stays with its owner, in few repositories, looks live.  By default the owner
is ``source`` and a repository a (``source``, ``lang``), stand-ins in a table without either.

Positions come from native functions: ``regexp_extract_all`` gives the matches, ``split`` by
the same pattern the text between them, and a running sum over both the code-point starts.
Only texts that hold a candidate at all (one ``rlike`` pass) are written to scratch; candidate
rows are made distinct by (hash, owner, repository) before they are counted, so a value that
a third of all rows hold meets in one row for each task and owner.

Defined results: null or empty text has no spans (checksum of the empty string); null owners
and repositories count as one of their own; repeated rows give repeated rows; an empty table
gives an empty result; only the named columns are read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, wide_key

MAX_OWNERS = 1
MAX_REPOS = 3
# fixed values: the patterns of the base kinds (letters of the key words in either case)
WORDS = ("password", "passwd", "secret", "token", "api_?key")
_EITHER = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in WORDS)
ASSIGN = rf"""({_EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
TOKEN = r"[A-Za-z0-9+/_-]+"
LEAST = {"assign": 6, "access": 20, "hex": 24, "token": 24}
#: a text without any of these holds no candidate
ANY = rf"""(?:{_EITHER})["']?\x20*[:=]|AKIA[A-Z0-9]{{16}}|[0-9a-f]{{24}}|[A-Za-z0-9+/_-]{{24}}"""
KINDS = {"assign": (ASSIGN, 2), "access": (ACCESS, 0), "hex": (rf"{HEX[:-1]}{{24,}}", 0), "token": (rf"{TOKEN[:-1]}{{24,}}", 0)}


def _matches(kind: str) -> Column:
    """Struct array (gap, match, value) of a kind over ``text``."""
    pattern, group = KINDS[kind]
    p = F.lit(pattern)
    return F.arrays_zip(F.regexp_extract_all("text", p, F.lit(0)).alias("hit"),
                        F.regexp_extract_all("text", p, F.lit(group)).alias("value"),
                        F.split("text", pattern, -1).alias("gap"))


def candidates(docs: DataFrame, text: Column, row: Column, repo: Column, owner: Column) -> DataFrame:
    """(row, repo, owner, kind, rank, start, stop, value hash) of every span, a row once."""
    texts = (docs.select(row.alias("row"), repo.alias("repo"), owner.alias("owner"), text.alias("text"))
             .where(F.col("text").rlike(ANY)).dropDuplicates(["row"]))
    texts = materialize(texts, "secret-texts")
    order = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    found = None
    for rank, kind in enumerate(KINDS):
        one = (texts.select("row", "repo", "owner", F.posexplode(_matches(kind)).alias("at", "m"))
               .where("m.hit is not null")
               .select("row", "repo", "owner", "at", F.lit(kind).alias("kind"), F.lit(rank).alias("rank"),
                       F.col("m.hit").alias("hit"), F.col("m.value").alias("value"),
                       F.length("m.gap").alias("gap")))
        found = one if found is None else found.union(one)
    found = found.withColumn("stop", F.sum(F.col("gap") + F.length("hit")).over(order))
    value = F.col("value")
    least = F.element_at(F.create_map(*(F.lit(x) for kv in LEAST.items() for x in kv)), F.col("kind"))
    mixed = (F.col("kind") != "token") | (value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9]"))
    return materialize(
        found.where((F.length("value") >= least) & mixed)
        .select("row", "repo", "owner", "kind", "rank", (F.col("stop") - F.length("hit")).alias("start"), "stop",
                F.sha2(value, 256).alias("hash")), "secret-spans")


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, n_repos, n_owners): distinct repositories and owners of every value."""
    held = spans.select("hash", F.struct("owner").alias("o"), F.struct("owner", "repo").alias("r")).distinct()
    by_owner = held.groupBy("hash", "o").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_cols=("source", "lang"), max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """A row for each row of ``docs``: id, counts by kind, base_sha256, spans, live, copied, and
    the most owners and repositories that a value of its spans has (0 without spans)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    owner = F.col(owner_col).cast("string")
    row = wide_key(F.col(id_col), text, owner, *(F.col(c) for c in repo_cols))
    spans = candidates(docs, text, row, F.struct(*(F.col(c) for c in repo_cols)), owner)
    spans = spans.join(ownership(spans), "hash").withColumn(
        "live", (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos))
    # a token inside a base span of its row adds nothing: the base spans' furthest end so far decides
    before = Window.partitionBy("row").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("rank")).rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("kind") != "token"
    spans = (spans.withColumn("reached", F.max(F.when(base, F.col("stop"))).over(before))
             .withColumn("next", F.min(F.when(base, F.col("start"))).over(after)))
    alone = (F.coalesce(F.col("reached"), F.lit(0)) <= F.col("start")) & (
        F.col("next").isNull() | (F.col("next") >= F.col("stop")))
    spans = spans.where(base | (F.col("live") & alone))
    name = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("stop").cast("string"))
    # the spans of one text: as many as that text holds
    listed = spans.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", name.alias("name"), "live"))).alias("s"),
        F.max("n_owners").alias("n_owners"), F.max("n_repos").alias("n_repos"))
    joined = lambda x: F.array_join(F.transform(x, lambda y: y["name"]), ",")
    count = lambda f: F.size(F.filter("s", f)).cast("long")
    ranked = lambda i: count(lambda y: y["rank"] == i)
    kinds = list(KINDS)
    listed = materialize(listed.select(
        "row", *(ranked(i).alias(f"n_{k}") for i, k in enumerate(kinds)),
        F.sha2(joined(F.filter("s", lambda y: y["rank"] < 3)), 256).alias("base_sha256"), joined(F.col("s")).alias("spans"),
        count(lambda y: y["live"]).alias("n_live"), count(lambda y: ~y["live"]).alias("n_copied"), "n_owners", "n_repos"), "secret-rows")
    rows = docs.select(F.col(id_col).alias("id"), row.alias("row"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*(f"n_{k}" for k in kinds), "n_live", "n_copied", "n_owners", "n_repos")]
    return rows.join(listed, "row", "left").select(
        "id", *zero, F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"))


def op4_secret_ownership(spark, sf_dir):
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumnRenamed("id", "doc_id").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_token", "n_live", "n_copied",
        "n_owners", "n_repos")


def _oracle() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    part = "\n  UNION ALL\n".join(
        f"  SELECT doc_id, source, lang, '{kind}' AS kind, {rank} AS rank, "
        f"regexp_extract_all(text, {quote(p)}) AS hits, regexp_extract_all(text, {quote(p)}, {g}) AS vals, "
        f"regexp_split_to_array(text, {quote(p)}) AS gaps FROM d" for rank, (kind, (p, g)) in enumerate(KINDS.items()))
    least = " ".join(f"WHEN '{k}' THEN {n}" for k, n in LEAST.items())
    return f"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents),
m AS (
{part}),
x AS (SELECT doc_id, source, lang, kind, rank, generate_subscripts(hits, 1) AS nth, unnest(hits) AS hit,
        unnest(vals) AS val, unnest(gaps[1:len(hits)]) AS gap FROM m WHERE len(hits) > 0),
y AS (SELECT *, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY nth) AS BIGINT) AS stop FROM x),
s AS (SELECT doc_id, source, lang, kind, rank, stop - length(hit) AS start, stop, sha256(val) AS hash FROM y
      WHERE length(val) >= CASE kind {least} END
        AND (kind <> 'token' OR (regexp_matches(val, '[A-Z]') AND regexp_matches(val, '[a-z]') AND regexp_matches(val, '[0-9]')))),
o AS (SELECT hash, count(DISTINCT coalesce(source, '\\x00')) AS n_owners,
        count(DISTINCT concat(coalesce(hex(source), '-'), ':', coalesce(hex(lang), '-'))) AS n_repos FROM s GROUP BY hash),
t AS (SELECT s.*, n_owners, n_repos, n_owners <= {MAX_OWNERS} AND n_repos <= {MAX_REPOS} AS live FROM s JOIN o USING (hash)),
k AS (SELECT * FROM t WHERE kind <> 'token' OR (live AND NOT EXISTS (
        SELECT 1 FROM t b WHERE b.doc_id = t.doc_id AND b.kind <> 'token' AND b.start < t.stop AND b.stop > t.start))),
n AS (SELECT *, concat(kind, ':', start, ':', stop) AS name FROM k),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'token') AS n_token,
        count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied,
        max(n_owners) AS n_owners, max(n_repos) AS n_repos,
        sha256(coalesce(string_agg(name, ',' ORDER BY start, rank) FILTER (kind <> 'token'), '')) AS base_sha256,
        string_agg(name, ',' ORDER BY start, rank) AS spans FROM n GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_token, 0) AS n_token,
  coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied,
  coalesce(n_owners, 0) AS n_owners, coalesce(n_repos, 0) AS n_repos
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""


ORACLE = _oracle()
