import re

import duckdb

from sparkfeat.llm import urls

URLS = ["http://a.example.org/es/1", "https://example.org/en/12?x=/es/", "http://EXAMPLE.ORG/en/2", "http://notexample.org/es/",
        "http://x.com/fr/a#b", "http://x.com/de", "http://x.com/de/", "http://com/fr/", "ftp://y.net", "no scheme at all", "", None,
        "http://spam-farm.example.net/", "http://spam-farm.example.org/fr/", "a://b://c.com/fr/", "http://x.net/?sessionid=ab12",
        "http://poker.x.net/", "http://x.net/poker.", "http://h.org", "http://h.org/", "http://u:p@h.com:80/fr/", "http://x.com?/fr/",
        "http://café.com/fr/é", "http://x.com/FR/", "http://" + "long." * 20_000 + "com/de/", "http://a.org/\nb", "://", "http://.org/"]


def by_hand(url):
    host = path = ""
    text = url
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        tail = rest[len(host) + len(path):]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        text = host + path + tail
    fits = [(len(h + p), h + p, v) for v, h, p in urls.HOST_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    bad = text is not None and any(re.search(p, text) for p, _ in urls.PATTERN_RULES)
    return host, path, None, "block" if bad else "allow"


def test_against_brute_force(spark):
    rows = [(i, u, "h", "p") for i, u in enumerate(URLS)] + [(None, URLS[0], "h", "p"), (0, URLS[0], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, token string")
    got = urls.judge(pages).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((r[0], *by_hand(r[1]))) for r in rows)


def test_shuffled_index_agrees(spark, monkeypatch):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    want = sorted(map(repr, urls.judge(pages).collect()))
    monkeypatch.setattr(urls, "BROADCAST_RULES", 0)
    assert sorted(map(repr, urls.judge(pages).collect())) == want


def test_bare_text_fits_no_host_rule(spark):
    bare = ["example.org/es/x", "a.org/x", "com/fr/", "x.com/de/?sessionid=ab12", "spam-farm.example.org/es/", "example.org/es/?u=http:/x"]
    rows = list(enumerate(bare + ["http://" + u for u in bare]))
    got = {r["id"]: tuple(r)[1:] for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got == {i: by_hand(u) for i, u in rows}
    assert all(got[i][2] is None for i in range(len(bare)))
    # a rule without a literal token is tried on every url
    rule = urls.Rule(r"^(?:[^/?#]*\.)?é/", (), "block", "é/")
    got = urls.judge(spark.createDataFrame([(0, "é/x"), (1, "http://é/x")], "page_id long, url string"), rules=[rule]).collect()
    assert {r["id"]: (r["rule"], r["verdict"]) for r in got} == {0: (None, "allow"), 1: ("é/", "block")}


def test_tokens_are_whole():
    assert urls.host_rule("block", "example.org", "/en/1").tokens == ("example", "org", "en")
    assert urls.host_rule("allow", "com", "/fr/").tokens == ("com", "fr")


def test_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = sorted(con.execute(urls.ORACLE).fetchall(), key=repr)
    assert sorted(map(tuple, urls.op9_url_rules(spark, sf).collect()), key=repr) == want
