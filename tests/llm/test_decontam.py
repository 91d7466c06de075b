import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkfeat.llm import decontam

from .data import DOCS, doc, edge_docs, frame, prose, words


def least_distance(pattern, text):
    """Brute force: least edit distance to any run of ``text``, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=90), st.lists(st.integers(0, 4), max_size=40))
def test_myers_is_the_edit_distance(pattern, text):
    masks = {}
    for j, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | 1 << j
    best, end = decontam.myers(masks, len(pattern), text)
    assert best == least_distance(pattern, text)
    assert 0 <= end <= len(text)


def test_pieces_cover_the_item():
    for n in range(1, 200):
        k = decontam.budget(n)
        p = decontam.pieces(n, k)
        assert len(p) == k + 1 and all(w > 0 for _, w in p)
        assert [x for a, w in p for x in range(a, a + w)] == list(range(n))


ITEMS = [(1, prose(50, 40)), (2, prose(51, 15)), (3, None), (4, " "), (5, "lone phrase here"), (2, prose(52, 20)),
         (None, prose(53, 30)), (6, prose(50, 40))]


def planted():
    r, rows = random.Random(3), edge_docs()
    for n in range(40):
        item = words(ITEMS[n % 2 if n % 7 else 6][1])
        k = r.randrange(0, len(item) // 4 + 3)
        for _ in range(k):
            at = r.randrange(len(item))
            kind = r.randrange(3)
            item[at:at + (kind != 0)] = [] if kind == 1 else [f"new{r.randrange(99)}"]
        text = words(prose(900 + n, 60))
        text[r.randrange(60):0] = item
        rows.append(doc(1000 + n, " ".join(text).upper() if n % 5 == 0 else "\n".join(text)))
    return rows + [doc(2000, "a lone phrase HERE."), doc(2001, "a lone Phrase here"), doc(2001, "a lone Phrase here")]


def found(rows):
    out = []
    for r in rows:
        for i, t in ITEMS:
            w = words(t)
            if w and least_distance(w, words(r[1])[:2000]) <= len(w) // 4:
                out.append((r[0], i))
    return out


def test_against_brute_force(spark):
    rows = [r for r in planted() if r[1] is None or len(r[1]) < 100_000]
    items = spark.createDataFrame([(*x, "clash") for x in ITEMS], "item_id long, text string, matches string")
    for block in (decontam.BLOCK_WORDS, 1):  # all items with a text at once; an item a block
        got = decontam.with_matches(frame(spark, rows), items, "m", block_words=block).select("doc_id", "m").collect()
        pairs = {(r["doc_id"], m["item"]) for r in got for m in r["m"]}
        assert pairs == set(found(rows))
    clean = decontam.decontaminate(frame(spark, planted()), items)
    assert clean.columns == DOCS.names
    dirty = {d for d, _ in found(rows)}
    assert sorted(map(repr, (r["doc_id"] for r in clean.collect()))) == sorted(
        repr(r[0]) for r in planted() if r[0] not in dirty)


def test_items_keep_their_ids(spark):
    items = [("mmlu-12", prose(60, 30)), (None, prose(61, 30)), ("x", None)]
    rows = [doc(1, prose(60, 30)), doc(2, "so: " + prose(61, 30)), doc(3, prose(62, 30)), doc(4, prose(61, 30) + prose(60, 30))]
    table = spark.createDataFrame(items, "item_id string, text string")
    got = decontam.with_matches(frame(spark, rows), table, "m").collect()
    assert {r["doc_id"]: sorted(map(repr, (m["item"] for m in r["m"]))) for r in got} == {
        1: ["'mmlu-12'"], 2: ["None"], 3: [], 4: ["'mmlu-12'", "None"]}
    assert [r["doc_id"] for r in decontam.decontaminate(frame(spark, rows), table).collect()] == [3]


def test_empty_sides(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    rows = edge_docs()[:8]
    assert decontam.decontaminate(frame(spark, rows), items).count() == len(rows)
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontam.decontaminate(frame(spark, []), some).count() == 0


def test_position_of_a_match(spark):
    items = spark.createDataFrame([(9, prose(50, 40))], "item_id int, text string")
    text = prose(7, 25) + " " + prose(50, 40) + " tail"
    got = decontam.with_matches(frame(spark, [doc(1, text), doc(1, text)]), items, "m").collect()
    assert [[m.asDict() for m in r["m"]] for r in got] == 2 * [[{"item": 9, "distance": 0, "start": 25, "stop": 65}]]


def test_places_of_an_item():
    assert list(decontam.places([5, 6, 200], 210, 20, 5)) == [(0, 31), (195, 210)]
    assert list(decontam.places([-3], 10, 8, 2)) == [(0, 7)]
    assert list(decontam.places([], 10, 8, 2)) == []


def test_names_that_clash(spark):
    """Columns named as the operator's own, and a full bitmap, change nothing."""
    clash = ["t1", "t2", "_t1", "_maybe", "words", "s1", "item", "pos", "a.b"]
    docs = frame(spark, [doc(1, prose(50, 40)), doc(2, prose(54, 40)), doc(2, prose(54, 40))])
    for i, name in enumerate(clash):
        docs = docs.withColumn(name, F.lit(i))
    items = spark.createDataFrame([(1, prose(50, 40), 7, 8)], "item_id long, text string, s1 int, piece int")
    got = decontam.decontaminate(docs, items)
    assert got.columns == docs.columns and [r["doc_id"] for r in got.collect()] == [2, 2]
    got = decontam.with_matches(docs, items, "m")
    assert got.columns == [*docs.columns, "m"] and sorted((r["doc_id"], len(r["m"])) for r in got.collect()) == [
        (1, 1), (2, 0), (2, 0)]


def test_a_dense_bitmap_loses_nothing(spark, monkeypatch):
    rows = [r for r in planted() if r[1] is None or len(r[1]) < 100_000]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(decontam, "BITS", (7, 7))
    got = decontam.with_matches(frame(spark, rows), items, "m").select("doc_id", "m").collect()
    assert {(r["doc_id"], m["item"]) for r in got for m in r["m"]} == set(found(rows))
