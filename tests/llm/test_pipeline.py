from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry
from sparkfeat.llm import decontam, mixing
from sparkfeat.llm.common import materialize

from .data import DOCS, doc, edge_docs, frame, prose, shingles, words
from .test_decontam import least_distance
from .test_jaccard import components

SF = "/root/testdata/sf0.001"


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "near_duplicates", "decontamination", "source_mixing", "shard_assignment"]
    names = entry.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)


def test_stages_against_brute_force(spark):
    """Every stage on the rows its predecessor kept."""
    items = [(r["item_id"], words(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 and toxic = 0").collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = materialize(stage(spark, docs, SF), "test-pipeline")
        after = [tuple(r) for r in docs.collect()]
        if name != "shard_assignment":
            assert docs.columns == columns and set(after) <= set(before)
        if name == "quality_classifier":
            kept = {r[0] for r in after}
            assert good <= kept and len(kept & bad) < len(bad)  # few labels here; test_quality has the accuracy
        elif name == "near_duplicates":
            want = {c for i, n, c in components(before) if n} | {r[0] for r in before if not shingles(r[1])}
            assert sorted(r[0] for r in after) == sorted(want)
        elif name == "decontamination":
            holds = {r[0] for r in before for _, w in items if set(w) & set(words(r[1])[:50_000])
                     and least_distance(w, words(r[1])) <= len(w) // 4}
            assert sorted(r[0] for r in after) == sorted(r[0] for r in before if r[0] not in holds) and holds
        elif name == "source_mixing":
            mix = mixing.curriculum_mix(spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long"))
            assert Counter(r[0] for r in after) == Counter({r["id"]: len(r["positions"]) for r in mix.collect() if r["positions"]})
        else:
            assert Counter(r[0] for r in before) == Counter(r[0] for r in after)
            count = Counter(r["shard"] for r in docs.collect())
            assert max(count.values()) - min(count.get(s, 0) for s in range(8)) <= 1


def test_edge_documents_pass_all_stages(spark):
    docs = frame(spark, edge_docs())
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(stage(spark, docs, SF), "test-edge")
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == DOCS.names
    assert docs.count() > 0


def test_empty_documents(spark):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "test-none")
    assert docs.count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot"]
