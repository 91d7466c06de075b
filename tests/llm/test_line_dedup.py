import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from sparkfeat.llm import line_dedup as L

from .data import doc, edge_docs, frame, prose

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, min_chars=40, min_docs=5):
    """(id, n_lines, n_dropped, kept text) of (id, text) rows, sorted."""
    holders = defaultdict(list)
    for r, (i, text) in enumerate(rows):
        for key in {line.strip(WHITE).translate(LOWER) for line in (text or "").split("\n")}:
            if len(key) >= min_chars:
                holders[key].append(-1 if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = []
        for line in lines:
            who = holders.get(line.strip(WHITE).translate(LOWER), [])
            if len(who) < min_docs or (-1 if i is None else i) == max(who):
                stay.append(line)
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def corpus():
    """Lines that repeat at every rate, inside a document too; white space, case, accents."""
    r = random.Random(5)
    pool = [prose(k, 12) for k in range(60)] + ["É" * 39, "É" * 40, "x" * 39 + " ", "short", "", " " * 60, "Y" * 200_000]
    docs = list(edge_docs())
    for i in range(400, 700):
        lines = [r.choice(pool[: 2 + i % 60]) for _ in range(r.randrange(1, 25))]
        lines = [r.choice(["", " ", "\t\r"]) + (x.upper() if r.random() < 0.3 else x) + r.choice(["", "\r", " \x0b"]) for x in lines]
        docs.append(doc(i if r.random() < 0.95 else None, "\n".join(lines)))
    hot = "the line that every third document holds, word for word"
    docs += [doc(1_000 + i, f"{prose(i, 9)}\n{hot}\n{hot}") for i in range(150)]
    return docs + [docs[-1], docs[-1], docs[40]]


@pytest.mark.parametrize("batches, fanout, sample", [(8, 4, L.SAMPLE), (7, 2, 64), (1, 2, L.SAMPLE)])
def test_against_brute_force(spark, monkeypatch, batches, fanout, sample):
    monkeypatch.setattr(L, "SAMPLE", sample)
    docs = corpus()
    table = frame(spark, docs).withColumn("n_lines", F.lit("taken")).withColumn("h", F.lit(1)).withColumn("lost", F.lit(2))
    out = L.dedup_lines(table, batches=batches, fanout=fanout)
    got = sorted(((r["doc_id"], r["_n_lines"], r["n_dropped"], r["text"]) for r in out.collect()), key=repr)
    assert got == by_hand([(d[0], d[1]) for d in docs])
    assert set(table.columns) < set(out.columns) and out.where("n_lines = 'taken' AND h = 1 AND lost = 2").count() == len(docs)


def test_bounds_are_parameters(spark):
    docs = corpus()
    out = L.dedup_lines(frame(spark, docs), min_chars=3, min_docs=2)
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()), key=repr)
    assert got == by_hand([(d[0], d[1]) for d in docs], 3, 2)


def test_runs(spark):
    """Levels are compacted, settled keys add nothing, any order of batches gives the same."""
    rows = [(i, f"{k:016d}".encode()) for i in range(200) for k in range(i % 40)]
    want = {}
    for i, h in rows:
        want.setdefault(h, []).append(i)
    want = {h: max(i) for h, i in want.items() if len(i) >= 5}
    for seed in (1, 2):
        order = list(range(10))
        random.Random(seed).shuffle(order)
        order = order if seed == 2 else sorted(order, reverse=True)
        runs = L.LineRuns(spark, 4, fanout=3)
        for b in order:
            runs.add(spark.createDataFrame([x for x in rows if x[0] // 20 == b], "id long, h binary"))
            assert all(len(level) < 3 for level in runs.levels)
        assert {bytes(r["h"]): r["top"] for r in runs.repeated().collect()} == want
        if seed == 1:  # descending: once five documents hold a key, later batches leave it out
            runs.add(spark.createDataFrame([x for x in rows if x[0] < 20], "id long, h binary"))
            assert runs.runs()[0].count() == 0


def test_a_batch_does_not_move_the_runs(spark):
    runs = L.LineRuns(spark, 4)
    keys = spark.createDataFrame([(i, b"%016d" % (i % 50)) for i in range(500)], "id long, h binary")
    for _ in range(3):
        runs.add(keys)
    plan = runs.unsettled(runs.runs()[0])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan


def test_other_ids_and_empty_table(spark):
    line = "a line of more than forty code points, held by all of them"
    rows = [(f"d{i}", f"{line}\n{i}") for i in range(9)]
    got = {r["doc_id"]: r["text"] for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {f"d{i}": str(i) if i < 8 else f"{line}\n8" for i in range(9)}
    assert L.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_oracle(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = L.op13_line_runs(spark, sf)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({L.ORACLE})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
