"""Landmark features of the Gaussian kernel, and what every kind of model learns."""
import numpy as np
import pytest
from pyspark.ml import PipelineModel

from sparkfeat.operators import evaluate as V
from sparkfeat.operators import models as M
from sparkfeat.session import scratch_path
from sparkfeat.sources import files as S

SCHEMA = "id long, x array<double>, label int"


def ring(n, seed):
    r = np.random.default_rng(seed)
    y = r.integers(0, 2, n)
    angle, radius = r.uniform(0, 2 * np.pi, n), np.where(y == 1, 2.0, 0.6) + r.normal(0, 0.35, n)
    return np.column_stack([radius * np.cos(angle), radius * np.sin(angle)]), y


def table(spark, X, y, first=0):
    return spark.createDataFrame([(first + i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(X, y))], SCHEMA)


def test_landmarks_leave_the_residual_asked_for():
    X, _ = ring(800, 1)
    few, left = M.pick_landmarks(X, 0.5, 0.1)
    many, less = M.pick_landmarks(X, 0.5, 0.001)
    assert left <= 0.1 and less <= 0.001 and len(few) < len(many) < 200
    same, none = M.pick_landmarks(np.ones((50, 2)), 0.5)
    assert len(same) == 1 and none == 0.0


def test_kernel_machine_on_a_ring(spark):
    (X, y), (Q, z) = ring(1_200, 2), ring(600, 3)
    train, test = table(spark, X, y), table(spark, Q, z, 10_000)
    model, _ = M.fit_model("rbf_svm", train, "x", "label")
    acc = V.accuracy(M.predict(model, test, "x", "id", "label")).first()["accuracy"]
    stage = model.stages[0]
    mean, worst = M.kernel_error(stage, Q[:300])
    print(f"kernel error: mean {mean:.4f}, largest {worst:.4f}; accuracy {acc:.4f}")
    assert mean < 0.01 and worst < 0.2
    # an exact kernel machine: regularised least squares in the full kernel
    gamma = stage.getOrDefault(stage.gamma)
    K = M.rbf_kernel(X, X, gamma)
    a = np.linalg.solve(K + 0.1 * np.eye(len(X)), 2.0 * y - 1.0)
    exact = float(np.mean((M.rbf_kernel(Q, X, gamma) @ a > 0) == (z == 1)))
    assert acc >= exact - 0.01
    loaded = S.load_model(S.save_model(model, scratch_path(spark, "ring")), PipelineModel)
    was, now = (sorted(map(tuple, M.predict(m, test, "x", "id", "label").collect())) for m in (model, loaded))
    assert was == now


@pytest.mark.parametrize("name", ["tree", "forest", "linear_svm", "mlp_large"])
def test_models_learn_a_separable_table(spark, name):
    r = np.random.default_rng(4)
    y = r.integers(0, 3, 450)
    X = np.eye(3)[y] * 4.0 + r.normal(0, 0.4, (450, 3))
    train, test = table(spark, X[:300], y[:300]), table(spark, X[300:], y[300:], 1_000)
    model, _ = M.fit_model(name, train, "x", "label")
    assert V.accuracy(M.predict(model, test, "x", "id", "label")).first()["accuracy"] >= 0.97
    assert M.n_params(model) > 0


def test_training_curve_rises(spark):
    r = np.random.default_rng(5)
    y = r.integers(0, 3, 450)
    X = np.eye(3)[y] * 4.0 + r.normal(0, 0.4, (450, 3))
    curve = M.training_curve(table(spark, X[:300], y[:300]), table(spark, X[300:], y[300:]), "x", "label", iterations=25, step=10)
    rows = curve.orderBy("iteration").collect()
    assert [c["iteration"] for c in rows] == [10, 20, 25]
    assert rows[-1]["loss"] < rows[0]["loss"] and rows[-1]["accuracy"] >= 0.97 and rows[-1]["val_accuracy"] >= 0.97
