import random

import pytest

from sparkfeat.llm import token_counts as t

from .data import doc, edge_docs, frame, prose

with open(t.VOCABULARY, "rb") as f:
    COUNT = t.counter(f.read())
PIECES = [" ", "  ", "\n", " a", "b ", "'s", " 12", "x y z", "\t x", "", "foo bar " * 90, "é", "'", "\u3000", "\x1f", "\U0001F600 "]


def spliced(text, edits):
    for e in edits or []:
        if e is not None:
            p = min(max(e["pos"] or 0, 0), len(text))
            text = text[:p] + (e["ins"] or "") + text[p + max(e["del"] or 0, 0):]
    return text


@pytest.mark.parametrize("run", [1, 16, 256])
def test_random_edits(run):
    r = random.Random(run)
    for n in range(25):
        text = "".join(r.choice(PIECES) + prose(n * 7 + i, 4, 30) for i in range(r.randrange(30)))
        runs = t.cut(text, run)
        assert "".join(runs) == text
        tree = t.SegmentTree(runs, [COUNT(x) for x in runs], COUNT, run)
        assert tree.n_tokens == COUNT(text)
        for _ in range(15):
            e = {"pos": r.randint(-2, len(text) + 3), "del": r.choice([-1, 0, 0, 1, 2, 5, 40, 700]), "ins": r.choice(PIECES)}
            tree.edit(e["pos"], e["del"], e["ins"])
            text = spliced(text, [e])
            assert (tree.text(), tree.n_tokens, tree.n_chars) == (text, COUNT(text), len(text))


def test_only_the_region_is_encoded():
    text = prose(1, 20_000)
    runs = t.cut(text)
    tree = t.SegmentTree(runs, [COUNT(x) for x in runs], COUNT)
    tree.edit(len(text) // 2, 5, "changed")
    assert tree.encoded_chars < 4 * t.RUN and tree.n_tokens == COUNT(tree.text())


def test_trees_through_spark(spark):
    rows = [(r[0], r[1], [(0, 1, "A"), None, (10**9, 5, " end"), (3, None, None), (-4, -1, None)][: i % 6] if i % 7 else None)
            for i, r in enumerate(edge_docs())]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, edits {t.EDITS}")
    voc = t.vocabulary_bytes(spark)
    trees = t.build_trees(docs, voc)
    for r in trees.collect():
        assert r["n_tokens"] == COUNT(r["text"] or "") == sum(r["run_tokens"])
        assert sum(r["run_chars"]) == len(r["text"] or "")
    got = t.apply_edits(trees.repartition(3), voc).collect()
    want = sorted((repr(i), len(x), COUNT(x)) for i, x in ((r[0], spliced(r[1] or "", [
        e and dict(zip(("pos", "del", "ins"), e)) for e in r[2] or []])) for r in rows))
    assert sorted((repr(r["doc_id"]), r["edited_chars"], r["edited_tokens"]) for r in got) == want
    # the edited trees are trees again
    again = t.apply_edits(t.apply_edits(trees, voc).select(
        "doc_id", "text", "run_chars", "run_tokens", t.F.lit([]).cast(t.EDITS).alias("edits")), voc)
    assert sorted((repr(r["doc_id"]), r["edited_chars"], r["edited_tokens"]) for r in again.collect()) == want


def test_query_against_full_counts(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    edits = {r[0]: (r[1], r[2]) for r in docs.withColumn("e", t.derived_edits(t.F.col("doc_id"), t.F.col("text"))).collect()}
    for r in t.op5_edit_aware_counts(spark, sf).collect():
        text, e = edits[r["doc_id"]]
        assert (r["n_tokens"], r["edited_tokens"]) == (COUNT(text), COUNT(spliced(text, e)))


def test_empty_table(spark):
    docs = frame(spark, []).withColumn("edits", t.F.lit(None).cast(t.EDITS))
    voc = t.vocabulary_bytes(spark)
    assert t.apply_edits(t.build_trees(docs, voc), voc).count() == 0


def test_columns_with_the_names_of_results(spark):
    docs = spark.createDataFrame([(1, "some text here", "mine", 7, [(0, 4, "any")])],
                                 f"doc_id long, text string, N_tokens string, edited_chars int, edits {t.EDITS}")
    voc = t.vocabulary_bytes(spark)
    trees = t.build_trees(docs, voc)
    got = t.apply_edits(trees, voc)
    assert trees.columns == ["doc_id", "text", "_N_tokens", "edited_chars", "edits", "run_chars", "run_tokens", "n_tokens"]
    r = got.first()
    assert (r["_N_tokens"], r["_edited_chars"], r["text"], r["edited_chars"]) == ("mine", 7, "any text here", 13)
    assert (r["n_tokens"], r["edited_tokens"]) == (COUNT("some text here"), COUNT("any text here"))
    with pytest.raises(ValueError, match="name of a result"):
        t.build_trees(docs, voc, "N_tokens")
