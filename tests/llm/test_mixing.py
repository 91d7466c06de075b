import hashlib

from collections import Counter

import duckdb
import pytest

from sparkfeat.llm import mixing

from .data import DOCS, doc, edge_docs, frame, prose, words


def mix_by_hand(rows, share=1.0, most=3):
    """Brute force: targets by repeated resharing, takes by walking the documents."""
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(len(words(r[1])) for r in rows if r[3] == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    left, target, open_ = share * sum(size.values()), {}, set(sources)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= most * size[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = float(most * size[s])
            left -= target[s]
        open_ -= full
    taken = {}
    for s in sources:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (
            hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest(), len(words(r[1]))))
        rest = int(target[s])
        for _ in range(most):
            for r in own:
                take = min(len(words(r[1])), rest)
                taken.setdefault((s, r[0], len(words(r[1]))), []).append(take)
                rest -= take
    return size, target, {k: sum(v) for k, v in taken.items()}


def test_against_brute_force(spark):
    rows = edge_docs()
    size, target, taken = mix_by_hand(rows)
    got = mixing.curriculum_mix(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_hand, by_spark = {}, {}
    for r in got:
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] <= 3 * r["size"] and (len(r["positions"]) > 0) == (r["taken"] > 0)
        assert r["positions"] == sorted(r["positions"]) and all(0 <= p <= 1 for p in r["positions"])
        k = (r["source"], r["id"], r["size"])
        by_spark[k] = by_spark.get(k, 0) + r["taken"]
    assert by_spark == taken
    for s in size:
        assert sum(r["taken"] for r in got if r["source"] == s) == int(target[s])


def test_mixed_documents(spark):
    rows = edge_docs()
    out = mixing.mixed(frame(spark, rows))
    assert out.columns == DOCS.names
    copies = sum(len(r["positions"]) for r in mixing.curriculum_mix(frame(spark, rows)).collect())
    assert out.count() == copies


def test_rows_that_differ_in_one_column_stay_apart(spark):
    """Whole rows as multisets: each row as often as its own positions say."""
    base = doc(1, "one two three")
    rows = [base, base[:2] + ("fr",) + base[3:], base[:2] + (None,) + base[3:], base, *edge_docs()[:12],
            *[doc(None, prose(k, 20)) for k in range(60)], *[doc(77, prose(k, 9), "s2") for k in range(60)]]
    table = frame(spark, rows)
    mix = mixing.curriculum_mix(table)
    assert mix.count() == len(rows)
    keyed = table.withColumn("row2", mixing._row(table))
    want = Counter()
    times = {}
    for r in mix.collect():
        times.setdefault(tuple(r["row"]), []).append(len(r["positions"]))
    for r in keyed.dropDuplicates(["row2"]).collect():
        want[repr(tuple(r)[:-1])] += sum(times[tuple(r["row2"])])
    assert Counter(repr(tuple(r)) for r in mixing.mixed(table).collect()) == +want
    assert {repr(base[:2] + (x,) + base[3:]) for x in ("en", "fr", None)} <= set(want)


def test_training_order_is_sorted(spark):
    order = mixing.training_order(mixing.curriculum_mix(frame(spark, edge_docs()))).collect()
    assert [r["position"] for r in order] == sorted(r["position"] for r in order)


def test_reruns_agree_and_hot_source(spark):
    rows = edge_docs() + [doc(5000 + i, prose(i, 3 + i % 40), "hot") for i in range(200)]
    a, b = (sorted((repr(r["id"]), r["size"], r["taken"], r["positions"]) for r in mixing.curriculum_mix(
        frame(spark, rows).repartition(n)).collect()) for n in (2, 9))
    assert a == b


def test_empty_and_wordless(spark):
    assert mixing.curriculum_mix(frame(spark, [])).count() == 0
    got = mixing.curriculum_mix(frame(spark, [doc(1, None), doc(2, "")])).collect()
    assert [(r["size"], r["taken"], r["positions"]) for r in got] == [(0, 0, [])] * 2
    assert mixing.mixed(frame(spark, [doc(1, None)])).count() == 0


def test_schedules_integrate_and_invert(spark):
    for knots in (*mixing.SCHEDULES, ((0, 0), (0.25, 3), (0.5, 0), (1, 2))):
        parts = mixing.integrate(knots)
        rows = spark.range(0, 101).selectExpr("id / 100 AS u").select(
            "u", mixing.position_at(parts, mixing.F.col("u")).alias("t")).collect()
        for r in rows:
            done = 0.0
            for t0, w0, slope, before in parts:
                if r["t"] >= t0:
                    x = r["t"] - t0
                    done = before + w0 * x + slope * x * x / 2
            assert done == pytest.approx(r["u"], abs=1e-9)
    with pytest.raises(ValueError):
        mixing.integrate(((0, 0), (1, 0)))


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = {r[0]: r[1:6] for r in con.execute(mixing.ORACLE).fetchall()}
    got = {r[0]: tuple(r[1:6]) for r in mixing.op3_curriculum_mix(spark, sf).collect()}
    assert got == want
