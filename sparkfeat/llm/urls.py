"""URL filters by rules indexed under their rarest literal token (operator 9).

A rule is a regular expression over the canonical url, ``host`` + ``path`` + ``rest``
(host lower-cased), with a verdict and a priority.  Its literal tokens are runs of
[a-z0-9] that every url it matches must hold as whole tokens.  Token frequencies are
counted over the urls of the table (for the rules' tokens only); each rule is filed under
its rarest token.  A url's distinct tokens fetch the rules filed under them by an equality
join, and only those rules run their regular expression.  Rules without a literal token
are tried on every url.

(host, path) rules become patterns too: ``example.org/es/`` fits its host, all subdomains
and every path that starts with ``/es/``; their label is kept and the longest wins.
Pattern rules judge the urls that no such rule fits; the verdict is ``block`` if one of
them matches, else ``allow``.

Urls are made distinct first, so a url or host with a third of all rows costs one
evaluation of each different url; a token that all urls share is only ever joined if some
rule has no rarer one.  The rule index is broadcast when it is below
``BROADCAST_RULES`` entries, else it is joined by a shuffle on the token.

Defined results: a null url or one without ``://`` has an empty host and path, fits no
rule and is judged on its text alone; null page ids and repeated rows are kept; an empty
table gives an empty result; only the two named columns are read.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

BROADCAST_RULES = 20_000
# fixed values: (verdict, host, path)
HOST_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: (pattern over host + path + rest, literal tokens): farms, pill and casino sites, trackers
PATTERN_RULES = (
    (r"^[^/?#]*\bspam-farm\.", ("spam", "farm")),
    (r"^[^/?#]*\bcheap-pills\.", ("cheap", "pills")),
    (r"^[^/?#]*\b(?:casino|poker)[^/?#]*\.", ()),
    (r"[?&]sessionid=[0-9a-f]+", ("sessionid",)),
)


@dataclass(frozen=True)
class Rule:
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    label: str | None = None  # of a (host, path) rule

    @property
    def priority(self) -> int:
        return len(self.label) if self.label else 0


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """A (host, path) rule as a pattern.  A literal token must end inside the rule: the
    last run of the path may go on in the url."""
    label = host.lower() + path
    whole = label if re.search(r"[^a-zA-Z0-9]$", label) else re.sub(r"[a-zA-Z0-9]+$", "", label)
    tokens = tuple(dict.fromkeys(re.findall(r"[a-z0-9]+", whole.lower())))
    return Rule(rf"^(?:[^/?#]*\.)?{re.escape(host.lower())}{re.escape(path)}", tokens, verdict, label)


DEFAULT_RULES = (*(host_rule(*r) for r in HOST_RULES), *(Rule(p, t, "block") for p, t in PATTERN_RULES))


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, rest): rest begins with ``?`` or ``#``."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    rest = F.regexp_extract(after, r"(?s)^[^?#]*(.*)$", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (F.coalesce(low, F.lit("")), F.coalesce(path, F.lit("")), F.coalesce(rest, F.lit("")))


def judge(pages: DataFrame, rules=DEFAULT_RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``pages``."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    host, path, rest = split_url(F.col("url"))
    urls = (rows.select("url").where("url is not null").distinct()
            .withColumn("host", host).withColumn("path", path).withColumn("rest", rest))
    text = F.when(F.instr("url", "://") > 0, F.concat("host", "path", "rest")).otherwise(F.col("url"))
    urls = materialize(urls.withColumn("text", text), "urls")
    tokens = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0)))
    spread = urls.select("url", "text", F.explode(tokens).alias("token"))

    table = spark.createDataFrame(
        [(i, r.pattern, r.verdict, r.label, r.priority, list(r.tokens)) for i, r in enumerate(rules)],
        "rule_id long, pattern string, verdict string, label string, priority int, tokens array<string>")
    small = len(rules) <= BROADCAST_RULES
    side = F.broadcast if small else (lambda x: x)
    literal = table.select("rule_id", F.explode("tokens").alias("token"))
    often = spread.join(side(literal.select("token").distinct()), "token").groupBy("token").agg(F.count("*").alias("n"))
    filed = (literal.join(often, "token", "left").groupBy("rule_id")
             .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token")))
    index = materialize(table.drop("tokens").join(filed, "rule_id", "left"), "url-rules")

    fetched = spread.join(side(index.where("token is not null")), "token")
    always = [r for r in rules if not r.tokens]
    # a (host, path) rule needs a host: bare text is for the pattern rules alone
    fits = (F.instr("url", "://") > 0) | F.col("label").isNull()
    hit = fetched.where(F.expr("text rlike pattern") & fits).select("url", "verdict", "label", "priority")
    for r in always:  # a handful of rules that no literal token can file
        tried = urls.where(F.instr("url", "://") > 0) if r.label else urls
        hit = hit.union(tried.where(F.col("text").rlike(r.pattern)).select(
            "url", F.lit(r.verdict), F.lit(r.label).cast("string"), F.lit(r.priority)))
    order = F.struct("priority", F.col("verdict") == "block", "label", "verdict")
    best = hit.groupBy("url").agg(F.max(order).alias("best")).select("url", "best.label", "best.verdict")
    known = urls.join(best, "url", "left").select(
        F.col("url").alias("known"), "host", "path", F.col("label").alias("rule"),
        F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    return (rows.join(known, rows["url"] == known["known"], "left")
            .select("id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                    "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict")))


def op9_url_rules(spark, sf_dir):
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumnRenamed("id", "page_id")


ORACLE = r"""
WITH u AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS after FROM pages),
h AS (
  SELECT page_id, url, after,
    coalesce(translate(regexp_extract(after, '^([^/?#]*)', 1),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(after, '^[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(after, '(?s)^[^?#]*(.*)$', 1), '') AS rest FROM u),
r(verdict, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                              ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
f AS (
  SELECT page_id, url, r.rh || r.rp AS rule, r.verdict,
    row_number() OVER (PARTITION BY page_id, url ORDER BY length(r.rh || r.rp) DESC) AS k
  FROM h JOIN r ON (host = r.rh OR ends_with(host, '.' || r.rh)) AND starts_with(path, r.rp))
SELECT h.page_id, h.host, h.path, f.rule,
  CASE WHEN f.verdict IS NOT NULL THEN f.verdict
       WHEN regexp_matches(t, '^[^/?#]*\bspam-farm\.') OR regexp_matches(t, '^[^/?#]*\bcheap-pills\.')
         OR regexp_matches(t, '^[^/?#]*\b(?:casino|poker)[^/?#]*\.') OR regexp_matches(t, '[?&]sessionid=[0-9a-f]+')
       THEN 'block' ELSE 'allow' END AS verdict
FROM (SELECT *, CASE WHEN after IS NULL THEN url ELSE host || path || rest END AS t FROM h) h
LEFT JOIN f ON f.page_id = h.page_id AND f.url = h.url AND f.k = 1
"""
