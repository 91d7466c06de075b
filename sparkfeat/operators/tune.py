"""Grid search with cross-validation.

``CrossValidator`` with the stratified ``fold`` column (L4) as ``foldCol``,
candidates fitted ``parallelism`` at a time; the table of all candidates has
the mean and (population) standard deviation of the fold scores.  The best
candidate is refitted on the whole training table and scored on the test
table.  (The kNN grid, G1, reuses one neighbour search: ``knn.knn_grid``.)
"""
from __future__ import annotations

import itertools
from typing import Dict, Sequence

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def grid_search(est, grid: Dict[str, Sequence], train: DataFrame, fold: str = "fold", metric: str = "accuracy",
                parallelism: int = 8, label: str = "label_d"):
    """Returns (cv_model, candidates DataFrame)."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(est.getParam(name), list(values))
    maps = builder.build()
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    k = int(train.agg(F.max(fold)).first()[0]) + 1  # folds are 0..k-1
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=ev, foldCol=fold, numFolds=k,
                        parallelism=parallelism, seed=42)
    model = cv.fit(train)
    spark = train.sparkSession
    rows = []
    for i, pm in enumerate(maps):
        params = {p.name: pm[p] for p in pm}
        rows.append((i, ", ".join(f"{k}={_fmt(v)}" for k, v in sorted(params.items())),
                     float(model.avgMetrics[i]), float(model.stdMetrics[i]) if model.stdMetrics else None))
    table = spark.createDataFrame(rows, "candidate int, params string, mean_score double, std_score double")
    # one row per candidate (bounded by the grid), so an unpartitioned rank is fine
    table = table.withColumn("rank", F.rank().over(Window.orderBy(F.desc("mean_score"), F.asc("candidate"))))
    return model, table


def _fmt(v):
    return "[" + ",".join(map(str, v)) + "]" if isinstance(v, (list, tuple)) else str(v)


def summary(cv_model, table: DataFrame, test: DataFrame, label: str = "label_d") -> DataFrame:
    """(metric, value) rows: best params, best CV score, test accuracy of the refit model."""
    best = table.orderBy("rank", "candidate").first()
    pred = cv_model.bestModel.transform(test)
    acc = pred.agg(F.avg((F.col("prediction") == F.col(label)).cast("double"))).first()[0]
    spark = test.sparkSession
    return spark.createDataFrame([("best_params", best["params"]), ("best_cv_score", repr(best["mean_score"])),
                                  ("test_accuracy", repr(acc))], "metric string, value string")
