"""Model, label dictionary and scaler in one saved bundle."""
import numpy as np
import pytest

from sparkfeat.session import scratch_path
from sparkfeat.sources.bundle import ModelBundle, fit_bundle


@pytest.fixture(scope="module")
def flowers(spark):
    r = np.random.default_rng(5)
    rows = [(i, float(r.normal(100 * (i % 3), 5)), float(r.normal(0.01 * (i % 3), 0.001)), ["rose", "aster", "lily"][i % 3]) for i in range(240)]
    rows += [(900, None, 0.0, "rose"), (901, float("nan"), 0.0, "lily"), (902, 1.0, 0.0, None), (903, 1.0, float("inf"), "rose")]
    return spark.createDataFrame(rows, "id long, wide double, narrow double, kind string").repartition(4)


@pytest.mark.parametrize("name", ["logistic", "rbf_svm"])
def test_bundle_learns_and_comes_back(spark, flowers, name):
    bundle = fit_bundle(flowers, ["wide", "narrow"], "kind", name)
    assert bundle.labels.classes == ["aster", "lily", "rose"]
    loaded = ModelBundle.load(spark, bundle.save(scratch_path(spark, f"bundle-{name}")))
    assert (loaded.cols, loaded.name, loaded.labels.classes) == (["wide", "narrow"], name, ["aster", "lily", "rose"])
    was, now = ({r["id"]: r for r in b.transform(flowers).collect()} for b in (bundle, loaded))
    assert {i: r["class_name"] for i, r in was.items()} == {i: r["class_name"] for i, r in now.items()} and len(was) == 244
    assert sum(r["kind"] == r["class_name"] for r in now.values() if r["id"] < 900) >= 238
    # a null or NaN feature gives no class; a row without a label is scored
    assert now[900]["class_name"] is None and now[901]["class_name"] is None and now[903]["class_name"] is None and now[902]["class_name"] == "rose"
    assert loaded.transform(flowers).columns == [*flowers.columns, "class_name"]


def test_unlabelled_table_is_scored(spark, flowers):
    bundle = fit_bundle(flowers, ["wide", "narrow"], "kind", "naive_bayes", "minmax_safe")
    got = bundle.transform(flowers.select("narrow", "wide").limit(0), "answer")
    assert got.columns == ["narrow", "wide", "answer"] and got.count() == 0
