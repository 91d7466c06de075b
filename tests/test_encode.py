"""Label dictionaries of any size; bottom-k draws of the isolation forest."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkfeat.operators import encode as E
from sparkfeat.operators import isoforest as I


def test_ids_are_sorted_positions(spark):
    df = spark.createDataFrame([("b",), ("a",), ("é",), ("Z",), ("b",), ("10",), ("9",)], "x string")
    enc = E.LabelEncoder("x").fit(df)
    labels = sorted({r[0] for r in df.collect()}, key=lambda s: s.encode())
    assert enc.classes == labels
    got = enc.transform(df).collect()
    assert all(r["x_id"] == labels.index(r["x"]) for r in got) and len(got) == 7
    back = enc.decode(enc.transform(df), "x_id", "name").collect()
    assert all(r["name"] == r["x"] for r in back)
    assert enc.decode(spark.createDataFrame([(99,)], "x_id int"), "x_id", "name").first()["name"] is None


@pytest.mark.parametrize("small", [E.LabelEncoderModel.SMALL, 0])
def test_unseen_and_null_labels_are_errors(spark, monkeypatch, small):
    monkeypatch.setattr(E.LabelEncoderModel, "SMALL", small)
    enc = E.LabelEncoder("x").fit(spark.createDataFrame([("a",), ("b",), (None,)], "x string"))
    assert enc.n == 2 and enc.transform(spark.createDataFrame([("b",)], "x string")).first()["x_id"] == 1
    for bad in ("c", None):
        with pytest.raises(Exception, match="unseen label"):
            enc.transform(spark.createDataFrame([("a",), (bad,)], "x string")).collect()


def test_a_million_labels_stay_off_the_driver(spark, tmp_path):
    df = spark.range(1_000_000).select(F.concat(F.lit("u"), "id").alias("x"))
    enc = E.LabelEncoder("x").fit(df)
    with pytest.raises(ValueError):
        enc.classes
    out = enc.transform(df.union(df.limit(1_000)))
    assert out.agg(F.count_distinct("x_id"), F.min("x_id"), F.max("x_id")).first()[:] == (1_000_000, 0, 999_999)
    enc.save(str(tmp_path / "enc"))
    again = E.LabelEncoderModel.load(spark, str(tmp_path / "enc"))
    assert (again.n, again.col, again.out) == (enc.n, "x", "x_id")
    assert again.transform(df.limit(5)).join(enc.transform(df.limit(5)), ["x", "x_id"]).count() == 5


def test_copies_draw_one_by_one():
    """Draws of c copies of a row are those of c rows: uniform, so many below the bound."""
    rows = np.arange(200, dtype=np.int64) * 7_919
    below = []
    for tree in range(60):
        at, u = I.draws(rows, np.full(200, 50), tree, 1, 0.02)
        assert (u < 0.02).all()
        below.append(len(at))
    assert abs(np.mean(below) - 200) < 15 and np.std(below) < 30  # binomial(10,000, 0.02): sd 14
    at, u = I.draws(np.array([5], np.int64), np.array([1_000_000]), 3, 1, 0.0003)
    assert 200 < len(at) < 400 and (np.diff(u) > 0).all()


def test_every_tree_draws_its_sample_with_a_third_of_the_rows_equal(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(3_000, 2))
    x[:1_000] = [0.25, -0.25]
    x[-30:] += 12.0  # planted
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    model = I.IsolationForest(["a", "b"], trees=40, sample=256, contamination=0.01).fit(df.drop("id"))
    same = I.IsolationForest(["a", "b"], trees=40, sample=256, contamination=0.01).fit(df.drop("id").repartition(13))
    for one, two in zip(model.forest, same.forest):
        assert all(np.array_equal(p, q) for p, q in zip(one, two))
    out = model.transform(df).where("is_outlier").select("id").toPandas()["id"]
    assert len(out) == 30 and set(out) == set(range(2_970, 3_000))
    # leaves of repeated values show that copies are drawn in proportion
    sizes = [adj[feature < 0].max() for feature, *_, adj in model.forest]
    assert min(sizes) > I.c_factor(50) and max(sizes) < I.c_factor(220)
