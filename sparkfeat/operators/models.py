"""Classifier zoo on pyspark.ml.

The reference fits sklearn / Keras models on one machine; here every model is
a ``pyspark.ml`` estimator trained by executors.  Differences that matter:

* logistic regression: multinomial, L2 with regParam = 1/n (sklearn's C=1 on
  the summed loss), no standardization;
* decision tree / forest: Spark bins split candidates (maxBins) and caps
  depth at 30; the forest is grown by ``operators.forest``;
* linear SVM: one-vs-rest hinge loss (sklearn's LinearSVC uses squared hinge);
* RBF SVM: Spark has no kernel SVM; landmark features (Nystroem), whose products
  are the kernel with gamma = 1 / (d var(X)) ("scale") on the landmarks' span, followed
  by the linear SVM.  Landmarks are added until they leave 1% of the kernel's trace on
  a bounded sample, 512 at most (``kernel_error`` states the error on any sample);
* dense networks: ``MultilayerPerceptronClassifier`` keeps the layer sizes
  but uses sigmoid hidden units and full-batch L-BFGS instead of ReLU and
  Adam on batches of 8 (``blockSize`` only stacks rows for the matrix
  products, so it stays at its default).
"""
from __future__ import annotations

import time
from typing import Callable, Dict, Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .forest import Forest
from .svm import JointSVM


def with_vectors(df: DataFrame, features: str, out: str = "features", label: str | None = None) -> DataFrame:
    """array column -> ml vector (and the label as double for pyspark.ml)."""
    d = df.withColumn(out, array_to_vector(F.col(features).cast("array<double>")))
    if label is not None:
        d = d.withColumn("label_d", F.col(label).cast("double"))
    return d


RAW = "_raw_features"


def model_input(df: DataFrame, features: str, label: str | None = None) -> DataFrame:
    """What fitted pipelines take: the features as a vector and as the array ``RAW``."""
    return with_vectors(df.withColumn(RAW, F.col(features).cast("array<double>")), RAW, "features", label)


def scale_gamma(df: DataFrame, features: str) -> float:
    """sklearn's gamma="scale": 1 / (n_features * X.var()) over all values."""
    dims = len(df.select(features).first()[0])
    var = df.select(F.explode(features).alias("x")).agg(F.var_pop(F.col("x").cast("double"))).first()[0]
    return 1.0 / (dims * var) if var else 1.0


CANDIDATES = 2_048  # rows at most from which landmarks are picked
LANDMARKS = 512  # and landmarks at most
RESIDUAL = 0.01  # share of the kernel's trace that may be left
MAPPED = 1_024  # rows that are mapped at once


def rbf_kernel(X: np.ndarray, Z: np.ndarray, gamma: float) -> np.ndarray:
    d2 = (X * X).sum(1)[:, None] + (Z * Z).sum(1)[None, :]
    dot = X @ Z.T
    dot *= 2.0
    d2 -= dot
    np.maximum(d2, 0.0, out=d2)
    d2 *= -gamma
    return np.exp(d2, out=d2)


def pick_landmarks(X: np.ndarray, gamma: float, residual: float = RESIDUAL, most: int = LANDMARKS) -> tuple[np.ndarray, float]:
    """Landmarks by pivoted Cholesky: always the row that those picked explain least, until
    they leave at most ``residual`` of the kernel's trace; (landmarks, share left)."""
    left = np.ones(len(X))
    picked, columns = [], np.zeros((len(X), min(most, len(X))))
    while len(picked) < columns.shape[1] and left.sum() > residual * len(X):
        i, j = int(left.argmax()), len(picked)
        if left[i] <= 1e-10:
            break
        k = rbf_kernel(X, X[i:i + 1], gamma)[:, 0] - columns[:, :j] @ columns[i, :j]
        columns[:, j] = k / np.sqrt(left[i])
        left = np.maximum(left - columns[:, j] ** 2, 0.0)
        left[i] = 0.0
        picked.append(i)
    return X[picked], float(left.sum() / len(X))


class Nystroem(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Features of an array column whose products are the Gaussian kernel on the span of the
    landmarks, as a saveable stage: it holds landmarks and kernel width and needs nothing
    else to score new rows."""

    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    dims = Param(Params._dummy(), "dims", "input length", TypeConverters.toInt)
    landmarks = Param(Params._dummy(), "landmarks", "landmark rows, one after the other", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, gamma=None, dims=None, landmarks=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def basis(self):
        """The map from rows to their kernel values with the landmarks (numpy)."""
        gamma = self.getOrDefault(self.gamma)
        Z = np.array(self.getOrDefault(self.landmarks)).reshape(-1, self.getOrDefault(self.dims))
        return lambda X: rbf_kernel(X, Z, gamma)

    def weights(self) -> np.ndarray:
        """What makes features of kernel values."""
        Z = np.array(self.getOrDefault(self.landmarks)).reshape(-1, self.getOrDefault(self.dims))
        values, vectors = np.linalg.eigh(rbf_kernel(Z, Z, self.getOrDefault(self.gamma)))
        keep = values > 1e-10 * values.max()
        return vectors[:, keep] / np.sqrt(values[keep])

    def features(self):
        """The map from rows to features (numpy)."""
        basis, W = self.basis(), self.weights()
        return lambda X: basis(X) @ W

    def _transform(self, dataset: DataFrame) -> DataFrame:
        phi = self.features()

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def nystroem(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for col in columns:  # a few rows at a time: a row of features is longer than its values
                for i in range(0, len(col), MAPPED):
                    yield pd.Series(list(phi(np.stack(col.iloc[i:i + MAPPED].to_numpy()).astype(np.float64))))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(nystroem(F.col(self.getInputCol()))))


def fit_nystroem(train: DataFrame, features: str, gamma: float, dims: int, seed: int = 42) -> Nystroem:
    """Landmarks from a bounded sample of the distinct rows, drawn by hash."""
    rows = (train.select(F.col(features).cast("array<double>").alias("x")).dropDuplicates()
            .orderBy(F.xxhash64(F.lit(seed), "x")).limit(CANDIDATES).collect())
    Z, _ = pick_landmarks(np.array([r["x"] for r in rows]), gamma)
    return Nystroem(inputCol=RAW, outputCol="features", gamma=gamma, dims=dims, landmarks=Z.ravel().tolist())


def kernel_error(stage: Nystroem, X: np.ndarray) -> tuple[float, float]:
    """(mean, largest) absolute error of the features' products against the kernel on a sample."""
    phi = stage.features()(X)
    off = np.abs(phi @ phi.T - rbf_kernel(X, X, stage.getOrDefault(stage.gamma)))
    return float(off.mean()), float(off.max())


def estimator(name: str, n_train: int, n_features: int, n_classes: int, seed: int = 42):
    """The estimators of the comparison, by name."""
    if name == "logistic":
        return LogisticRegression(featuresCol="features", labelCol="label_d", maxIter=1000, regParam=1.0 / n_train,
                                  elasticNetParam=0.0, family="multinomial", standardization=False)
    if name == "tree":
        return DecisionTreeClassifier(featuresCol="features", labelCol="label_d", maxDepth=20, seed=seed)
    if name == "forest":
        # rows are kept by the nodes in which they lie
        return Forest(featuresCol="features", labelCol="label_d", numTrees=30, maxDepth=20, seed=seed, cacheNodeIds=True)
    if name in ("linear_svm", "rbf_svm"):
        # one binary problem per class, fitted in the same passes
        return JointSVM(classifier=LinearSVC(maxIter=100, tol=1e-4, regParam=1.0 / n_train), featuresCol="features",
                        labelCol="label_d")
    if name == "naive_bayes":
        return NaiveBayes(featuresCol="features", labelCol="label_d", modelType="gaussian")
    if name == "mlp_small":
        return MultilayerPerceptronClassifier(featuresCol="features", labelCol="label_d",
                                              layers=[n_features, 16, 8, n_classes], maxIter=50, seed=seed)
    if name == "mlp_large":
        return MultilayerPerceptronClassifier(featuresCol="features", labelCol="label_d",
                                              layers=[n_features, 64, 32, 16, n_classes], maxIter=50, seed=seed)
    raise ValueError(name)


MODELS = ["logistic", "tree", "forest", "linear_svm", "rbf_svm", "naive_bayes", "mlp_small", "mlp_large"]


def n_params(model) -> int:
    """Parameter / node count (M12): coefficients (+ intercepts), tree nodes, weights."""
    m = model.stages[-1] if isinstance(model, PipelineModel) else model
    cls = type(m).__name__
    if cls == "LogisticRegressionModel":
        return int(m.coefficientMatrix.numRows * m.coefficientMatrix.numCols + len(m.interceptVector))
    if cls == "DecisionTreeClassificationModel":
        return int(m.numNodes)
    if cls == "ForestModel":
        return int(m.totalNumNodes)
    if cls == "OneVsRestModel":
        return int(sum(len(x.coefficients) + 1 for x in m.models))
    if cls == "MultilayerPerceptronClassificationModel":
        return int(m.weights.size)
    if cls == "NaiveBayesModel":
        return int(m.theta.numRows * m.theta.numCols * 2 + len(m.pi))
    return 0


def mlp_param_count(layers) -> int:
    """Weights + biases of a dense network: sum (a + 1) * b over consecutive layers."""
    return int(sum((a + 1) * b for a, b in zip(layers[:-1], layers[1:])))


ROWS_A_TASK = 10_000  # training rows for which a task of its own pays
VALUES_A_TASK = 4_000_000  # feature values that a task holds at most, where a scan's files make fewer tasks


def spread(d: DataFrame, n: int, most: int, width: int, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """A training table of ``n`` rows, ``most`` of them in its fullest partition, in partitions
    for the passes of a fit: a small table in few, a large one in as many as keep them bounded."""
    full = max(rows_a_task, VALUES_A_TASK // max(width, 1))
    if most > 2 * full:
        return d.repartition(-(-n // full))
    return d.coalesce(max(1, -(-n // rows_a_task)))


def fullest_partition(df: DataFrame) -> tuple[int, int]:
    """Rows, and rows of the fullest partition."""
    sizes = df.groupBy(F.spark_partition_id().alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    r = sizes.agg(F.sum("_n").alias("n"), F.max("_n").alias("most")).first()
    return int(r["n"] or 0), int(r["most"] or 0)


def fit_model(name: str, train: DataFrame, features: str, label: str, seed: int = 42):
    """Fit one named model on a table with an array feature column; returns (PipelineModel, seconds)."""
    n, most = fullest_partition(train)
    dims = len(train.select(features).first()[0])
    k = train.select(label).distinct().count()
    stages = []
    if name == "rbf_svm":
        # the map is a stage of the pipeline, from the array column to the feature vector
        stages.append(fit_nystroem(train, features, scale_gamma(train, features), dims, seed))
    # every iteration is a job over all partitions: a small table has few, a large one no large ones
    d = spread(model_input(train, features, label).select("features", "label_d"), n, most, dims).cache()
    d.count()
    est = estimator(name, n, dims, int(train.agg(F.max(label)).first()[0]) + 1 if name.startswith("mlp") else k, seed)
    if stages:  # the rows are kept as they are and mapped in the passes of the fit
        est.through = stages[0]
    t0 = time.perf_counter()
    model = PipelineModel(stages=[*stages, est.fit(d)])
    secs = time.perf_counter() - t0
    d.unpersist()
    return model, secs


def predict(model: PipelineModel, df: DataFrame, features: str, key: str, label: str, name: str = "",
            seed: int = 42) -> DataFrame:
    """(key, label, pred int)."""
    src = model_input(df, features)
    if isinstance(model.stages[0], Nystroem):
        src = src.drop("features")
    return model.transform(src).select(key, label, F.col("prediction").cast("int").alias("pred"))


def history(model: PipelineModel) -> list:
    """Objective value per iteration (M13); empty for models that are not fitted by
    iterations over an objective (trees, forests, naive Bayes, one-vs-rest)."""
    m = model.stages[-1]
    summary = getattr(m, "summary", None)
    if summary is None or not getattr(m, "hasSummary", False):
        return []
    summary = summary() if callable(summary) else summary
    return [float(x) for x in summary.objectiveHistory]


def training_curve(train: DataFrame, validation: DataFrame, features: str, label: str, hidden=(16, 8), iterations: int = 50,
                   step: int = 10, seed: int = 42) -> DataFrame:
    """(iteration, loss, accuracy, val_accuracy) of a dense network's fit.

    The fit goes on in legs of ``step`` iterations, each from the weights of the one before;
    after every leg both tables are scored by one aggregation each.  The tables are read once."""
    n, dims = train.count(), len(train.select(features).first()[0])
    k = int(train.agg(F.max(label)).first()[0]) + 1
    few = max(1, -(-n // ROWS_A_TASK))
    d = with_vectors(train, features, "features", label).select("features", "label_d").coalesce(few).cache()
    v = with_vectors(validation, features, "features", label).select("features", "label_d").cache()
    right = F.avg((F.col("prediction") == F.col("label_d")).cast("double"))
    rows, weights, done = [], None, 0
    while done < iterations:
        leg = min(step, iterations - done)
        est = MultilayerPerceptronClassifier(featuresCol="features", labelCol="label_d", layers=[dims, *hidden, k],
                                             maxIter=leg, seed=seed)
        if weights is not None:
            est.setInitialWeights(weights)
        model = est.fit(d)
        weights, done = model.weights, done + leg
        rows.append((done, float(model.summary().objectiveHistory[-1]), model.transform(d).agg(right).first()[0],
                     model.transform(v).agg(right).first()[0]))
    d.unpersist()
    v.unpersist()
    return train.sparkSession.createDataFrame(rows, "iteration int, loss double, accuracy double, val_accuracy double")
