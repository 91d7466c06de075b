"""Linear machines of all classes side by side, against Spark's one after the other."""
import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.functions import array_to_vector

from sparkfeat.operators import models as M
from sparkfeat.operators import svm as S


def _table(spark, n=600, seed=4):
    r = np.random.default_rng(seed)
    X = r.normal(size=(n, 4)) * [1, 20, 1, 0.1] + [0, 300, 0, 0]
    y = (X[:, 0] + (X[:, 1] - 300) / 20 + r.normal(size=n) * 0.5 > 0).astype(int) + (X[:, 2] > 0.9)
    df = spark.createDataFrame([(i, X[i].tolist(), int(y[i])) for i in range(n)], "id long, x array<double>, y int")
    return df, X, y


def _objective(w, b, X, y, penalty):
    return np.maximum(0, 1 - y * (X @ w + b)).mean() + 0.5 * penalty * ((w * X.std(0, ddof=1)) ** 2).sum()


def test_as_good_as_one_machine_after_the_other(spark):
    df, X, y = _table(spark)
    d = M.with_vectors(df, "x", "features", "y").coalesce(1)
    one = LinearSVC(maxIter=100, tol=1e-4, regParam=1.0 / len(y))
    ours, theirs = (k(classifier=one, featuresCol="features", labelCol="label_d").fit(d) for k in (S.JointSVM, OneVsRest))
    assert len(ours.models) == len(theirs.models) == 3
    for i, (a, b) in enumerate(zip(ours.models, theirs.models)):
        got, want = (_objective(m.coefficients.toArray(), m.intercept, X, np.where(y == i, 1, -1), 1 / len(y)) for m in (a, b))
        assert got <= want * 1.01 + 1e-3
    right = [m.transform(d).where("prediction = label_d").count() for m in (ours, theirs)]
    assert abs(right[0] - right[1]) <= 0.02 * len(y) and right[0] > 0.6 * len(y)


def test_a_pass_serves_all_classes(spark, monkeypatch):
    df, _, _ = _table(spark)
    seen, side = [], S.side_by_side
    monkeypatch.setattr(S, "side_by_side", lambda problems, ev: side(problems, lambda p: seen.append(len(p)) or ev(p)))
    M.estimator("linear_svm", 600, 4, 3).fit(M.with_vectors(df, "x", "features", "y").repartition(3))
    assert seen[:5] == [3] * 5 and len(seen) < 400


def test_kernel_features_are_never_a_table(spark, monkeypatch):
    """A row of kernel features is up to 512 numbers; the fit keeps the rows that it was given."""
    r = np.random.default_rng(3)
    X, y = r.normal(size=(400, 4)), r.integers(0, 3, 400)
    X[:, 0] += 2 * y
    df = spark.createDataFrame([(X[i].tolist(), int(y[i])) for i in range(len(y))], "x array<double>, y int")
    widths, fit = [], S.JointSVM._fit
    monkeypatch.setattr(S.JointSVM, "_fit", lambda self, d: widths.append(len(d.first()["features"])) or fit(self, d))
    monkeypatch.setattr(S, "CHUNK", 64)
    model, _ = M.fit_model("rbf_svm", df, "x", "y")
    stage, machines = model.stages
    assert widths == [4] and machines.models[0].numFeatures == stage.weights().shape[1] > 4
    mapped = stage.transform(M.model_input(df, "x", "y").drop("features"))
    plain = S.JointSVM(classifier=LinearSVC(maxIter=100, tol=1e-4, regParam=1.0 / len(y)), featuresCol="features", labelCol="label_d")
    for a, b in zip(machines.models, fit(plain, mapped).models):
        phi = stage.features()(X)
        one, two = (_objective(m.coefficients.toArray(), m.intercept, phi, np.where(y == machines.models.index(a), 1, -1), 1 / len(y)) for m in (a, b))
        assert abs(one - two) < 0.02 * max(one, two) + 1e-3


def test_rows_are_mapped_a_few_at_a_time(spark, monkeypatch):
    df, X, _ = _table(spark, 90)
    stage = M.fit_nystroem(df, "x", 0.01, 4)
    monkeypatch.setattr(M, "MAPPED", 7)
    d = stage.transform(df.coalesce(1).withColumn(M.RAW, df["x"])).orderBy("id")
    assert np.allclose(np.array([r["features"].toArray() for r in d.collect()]), stage.features()(X))


def test_rows_without_a_label_are_in_no_class(spark):
    df, _, _ = _table(spark, 200)
    d = M.with_vectors(df, "x", "features", "y")
    d = d.select("features", M.F.when(M.F.col("id") % 10 > 0, M.F.col("label_d")).alias("label_d"))
    one = LinearSVC(maxIter=50, tol=1e-4, regParam=0.01)
    ours, theirs = (k(classifier=one, featuresCol="features", labelCol="label_d").fit(d) for k in (S.JointSVM, OneVsRest))
    both = [[r["prediction"] for r in m.transform(d).collect()] for m in (ours, theirs)]
    assert np.mean(np.array(both[0]) == both[1]) > 0.95
    with pytest.raises(ValueError):
        S.JointSVM(classifier=one, featuresCol="features", labelCol="label_d").fit(
            spark.createDataFrame([([float("nan")], 0.0), ([1.0], 1.0)], "x array<double>, label_d double").withColumn("features", array_to_vector("x")))


def test_minimise_finds_the_least_value():
    A = np.diag([1.0, 50.0, 3.0])
    at = np.array([3.0, -2.0, 5.0])
    found = S.side_by_side({"a": S.minimise(3, 100, 1e-12)}, lambda p: {i: ((x - at) @ A @ (x - at) / 2, A @ (x - at)) for i, x in p.items()})
    assert np.allclose(found["a"], at, atol=1e-4)
