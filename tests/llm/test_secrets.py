import hashlib
import re

import duckdb

from sparkfeat.llm import secret_scan

from .data import doc, edge_docs, frame

ASSIGN = re.compile(r"""((?a:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text or "") if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(out)


HEX = "0123456789abcdef" * 2
LONG = "aB3" * 9
ROWS = [doc(1, f'é password="{HEX}" x'), doc(2, "PassWd : abc secret=tok token = 12345678, api_key:'q1w2e3r4'"),
        doc(3, "AKIA12 AKIA" + "Z9" * 8 + " AKIA" + "A" * 15), doc(4, f"{HEX}{HEX} {HEX[:23]} {HEX[:24]}"),
        doc(5, "secret=token : abcdefgh"), doc(6, "ſecret=abcdefgh toKen=abcdefgh"), doc(7, f"see {LONG} end", "s1"),
        doc(8, f"see {LONG}q end", "s1"), doc(9, f"see {LONG} end", "s2"), doc(9, f"see {LONG} end", "s2"),
        doc(10, f"token={LONG}z tail", None), doc(11, ("x " * 5000) + f"token={HEX} " * 2000), doc(12, f"\U0001F600 token={HEX}"),
        doc(13, f"see {LONG}q end", "s1", "fr")]


def test_base_spans_against_brute_force(spark):
    rows = [(r[0] + 7000, *r[1:]) for r in ROWS] + edge_docs()
    got = secret_scan.scan(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    kinds = ("assign", "access", "hex")
    want = []
    for r in rows:
        spans = base(r[1])
        text = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)
        want.append((r[0], *(sum(k == i for _, k, _ in spans) for i in range(3)), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(repr, ((r["id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got))) == sorted(map(repr, want))
    for r in got:
        assert [s for s in r["spans"].split(",") if s and not s.startswith("token:")] == [
            f"{kinds[k]}:{a}:{b}" for a, k, b in base(next(x[1] for x in rows if x[0] == r["id"]))] or r["id"] is None


def test_ownership_decides(spark):
    got = {r["id"]: r for r in secret_scan.scan(frame(spark, ROWS)).collect()}
    # held by two owners: a copied example, no span of its own; one owner, two repositories: live
    assert got[7]["spans"] == got[9]["spans"] == "" and got[8]["spans"] == got[13]["spans"] == f"token:4:{4 + len(LONG) + 1}"
    assert (got[8]["n_token"], got[8]["n_live"], got[8]["n_copied"]) == (1, 1, 0)
    # inside a base span a token adds nothing
    assert got[10]["spans"] == f"assign:0:{6 + len(LONG) + 1}"
    loose = {r["id"]: r for r in secret_scan.scan(frame(spark, ROWS), max_owners=2).collect()}
    assert loose[7]["spans"] == f"token:4:{4 + len(LONG)}"


def test_repositories_decide_too(spark):
    value = "Zx9" * 10
    rows = [doc(i, f"{i} see {value} end", "one", lang) for i, lang in enumerate(["en", "fr", "de", "es", None])]
    rows += [doc(50 + i, f"{i} see {value}q end", "two", lang) for i, lang in enumerate(["en", "fr", None])] + [doc(90, "none", "two")]
    got = {r["id"]: r for r in secret_scan.scan(frame(spark, rows)).collect()}
    # one owner in five repositories is a copied example, in three it looks live
    assert all((got[i]["spans"], got[i]["n_owners"], got[i]["n_repos"]) == ("", 0, 0) for i in range(5))
    assert all((got[i]["n_live"], got[i]["n_owners"], got[i]["n_repos"]) == (1, 1, 3) for i in (50, 51, 52))
    assert (got[90]["n_owners"], got[90]["n_repos"]) == (0, 0)
    loose = {r["id"]: r for r in secret_scan.scan(frame(spark, rows), max_repos=5).collect()}
    assert loose[0]["n_repos"] == 5 and loose[0]["n_live"] == 1


def test_no_python_on_the_main_path(spark):
    plan = secret_scan.scan(frame(spark, ROWS))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)


def test_empty_table(spark):
    assert secret_scan.scan(frame(spark, [])).count() == 0


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(secret_scan.ORACLE).fetchall())
    assert sorted(map(tuple, secret_scan.op4_secret_ownership(spark, sf).collect())) == want
