import math

import numpy as np
import pyarrow as pa

from sparkfeat.llm import quality
from sparkfeat.llm.textkit import words

from .data import DOCS, doc, edge_docs, frame, prose

SF = "/root/testdata/sf0.1"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def corpus():
    good = [doc(i, prose(i, 20 + i % 50)) for i in range(400)]
    bad = [doc(1000 + i, " ".join(f"junk{(i * 7 + j) % 40}!!" for j in range(60))) for i in range(80)]
    return good + bad + [doc(5000, None), doc(5001, ""), doc(None, prose(9, 30)), doc(2, prose(2, 22)), doc(5002, "junk1!! " * 60_000)]


def marks():
    return ([(i, 1, 0, "a") for i in range(0, 400, 2)] + [(1000 + i, 0, 0, "a") for i in range(0, 80, 2)] +
            [(None, 1, 0, "a"), (1, None, 0, "a"), (3, 1, 0, "a"), (3, 0, 0, "a"), (5, 1, None, "a"), (7, 1, 1, "a"), (7, 1, 1, "a")])


def test_weights_against_brute_force(spark):
    docs, marked = frame(spark, corpus()), labels(spark, marks())
    sample = {r["id"]: r for r in quality.label_sample(marked).collect()}
    assert 3 not in sample and None not in sample and 1 not in sample and not sample[7]["good"] and sample[5]["good"]

    def grams(text):
        out = []
        for _, h, off in words(pa.array([text or ""])):
            w = h.tolist()
            out = [("1", x) for x in w] + [("2", x, y) for x, y in zip(w, w[1:])]
        f = quality._features(np.array([x[1] for x in out if x[0] == "1"], np.uint64), np.array([0, sum(x[0] == "1" for x in out)]))[0]
        assert len(f) == len(out)
        return f

    raw, target = np.full(quality.BUCKETS, quality.SMOOTH), np.full(quality.BUCKETS, quality.SMOOTH)
    for r in corpus():
        f = grams(r[1])
        np.add.at(raw, f, 1)
        s = sample.get(r[0])
        if s and s["good"] and not s["held"]:
            np.add.at(target, f, 1)
    model = np.log(target / target.sum()) - np.log(raw / raw.sum())
    scored, _ = quality.with_weights(docs.drop("log_weight"), marked)
    for r in scored.collect():
        assert math.isclose(r["log_weight"], float(model[grams(r["text"])].sum()), rel_tol=1e-9, abs_tol=1e-6)


def test_good_documents_stay_and_junk_goes(spark):
    docs = frame(spark, corpus())
    out = quality.accepted(docs, labels(spark, marks()))
    assert out.columns == DOCS.names
    kept = [r["doc_id"] for r in out.collect()]
    assert set(range(400)) <= set(kept) and kept.count(2) == 2 and {5000, 5001, None} <= set(kept)
    assert not any(i is not None and (1000 <= i < 1080 or i == 5002) for i in kept)
    again = quality.accepted(docs.repartition(7), labels(spark, marks())).collect()
    assert sorted(map(repr, (r["doc_id"] for r in again))) == sorted(map(repr, kept))


def test_k_largest_keys(spark):
    docs, marked = frame(spark, corpus()).drop("log_weight"), labels(spark, marks())
    scored, _ = quality.with_weights(docs, marked)
    keys = sorted((r["sample_key"] for r in scored.collect()), reverse=True)
    for k in (1, 50, 333):
        got = sorted((r["sample_key"] for r in quality.resample(docs, marked, k=k).collect()), reverse=True)
        assert got == [x for x in keys if x >= keys[k - 1]]
    assert quality.resample(docs, marked, k=0).count() == 0
    # more than there are: all that were drawn, none that was turned down
    drawn = [x for x in keys if x > float("-inf")]
    assert len(drawn) < len(keys) and quality.resample(docs, marked, k=10**6).count() == len(drawn)


def test_noise_is_gumbel(spark):
    docs = frame(spark, [doc(i, "same text") for i in range(4000)]).drop("log_weight")
    scored, _ = quality.with_weights(docs, labels(spark, marks()))
    g = np.array([r["sample_key"] - r["log_weight"] for r in scored.collect()])
    assert abs(g.mean() - 0.5772) < 0.08 and abs(g.std() - math.pi / math.sqrt(6)) < 0.08


def test_without_labels_and_empty(spark):
    none = labels(spark, [])
    assert quality.accepted(frame(spark, edge_docs()), none).count() == len(edge_docs())
    assert quality.accepted(frame(spark, []), labels(spark, marks())).count() == 0


def test_held_out_accuracy(spark):
    """Labels that the sample's bound leaves out: good documents stay, most junk goes."""
    marked = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scored, sample = quality.with_weights(docs, marked, max_labels=2_000)
    least = quality.selection(scored, sample, "doc_id", "log_weight", "sample_key")
    used = {r["id"] for r in sample.collect()}
    rows = [(r["quality"], r["sample_key"] >= least) for r in scored.join(marked, "doc_id").where("toxic = 0").collect()
            if r["doc_id"] not in used]
    good, junk = [k for q, k in rows if q == 1], [k for q, k in rows if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(junk) <= 0.4 * len(junk)


def test_toxic_documents_go(spark):
    """Held-out labels: clean documents stay, toxic ones with marker words go."""
    marked = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").join(marked, "doc_id")
    kept = {r["doc_id"] for r in quality.resample(docs, marked).select("doc_id").collect()}
    held = {r["id"] for r in quality.label_sample(marked).where("held").collect()}
    marks = {"trash", "pathetic", "idiot", "disgusting", "worthless", "clown", "loser", "scum", "stupid", "moron"}
    rows = docs.select("doc_id", "text", "quality", "toxic").collect()
    clean = [r["doc_id"] in kept for r in rows if r["quality"] == 1 and r["toxic"] == 0 and r["doc_id"] in held]
    toxic = [(r["doc_id"] in kept, bool(marks & set((r["text"] or "").split()))) for r in rows
             if r["quality"] == 1 and r["toxic"] == 1 and r["doc_id"] in held]
    print("clean kept", sum(clean), len(clean), "toxic kept", sum(k for k, _ in toxic), len(toxic),
          "with a marker", sum(k for k, m in toxic if m), sum(m for _, m in toxic))
    assert sum(clean) >= 0.99 * len(clean)
    assert sum(k for k, m in toxic if m) <= 0.05 * sum(m for _, m in toxic)
