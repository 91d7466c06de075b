"""A classifier saved with what its inputs and outputs need.

A bundle holds the fitted label dictionary (E1), the scaler of the feature columns (N1-N6)
and the ``pyspark.ml`` pipeline, so that a table with raw columns is scored and the answer
is a class name, in this session or after a load in another.
"""
from __future__ import annotations

import json
from typing import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import models as M
from ..operators.encode import LabelEncoder, LabelEncoderModel
from ..operators.scale import Scaler, ScalerModel
from .files import load_model, save_model

_X, _Y = "_bundle_features", "_bundle_label"


class ModelBundle:
    def __init__(self, model: PipelineModel, labels: LabelEncoderModel, scaler: ScalerModel, cols: Sequence[str], name: str):
        self.model, self.labels, self.scaler, self.cols, self.name = model, labels, scaler, list(cols), name

    def _complete(self) -> Column:
        """Whether a row has all features as finite numbers."""
        ok = F.lit(True)
        for c in self.cols:
            ok = ok & F.coalesce(F.abs(F.col(c).cast("double")) < float("inf"), F.lit(False))  # NaN is the largest
        return ok

    def _scaled(self, df: DataFrame) -> DataFrame:
        parts = self.scaler.transform(df.withColumn("_bundle_ok", self._complete()), "__scaled")
        x = F.array(*(F.when(F.col("_bundle_ok"), F.nanvl(f"{c}__scaled", F.lit(0.0))).otherwise(0.0) for c in self.cols))
        return parts.withColumn(_X, x).drop(*(f"{c}__scaled" for c in self.cols))

    def transform(self, df: DataFrame, out: str = "class_name") -> DataFrame:
        """``df`` with the predicted class name; null for a row with a feature that is no
        finite number.  A column that the scaler maps to NaN (constant) counts as 0."""
        d = M.model_input(self._scaled(df), _X)
        if isinstance(self.model.stages[0], M.Nystroem):
            d = d.drop("features")
        scored = self.model.transform(d).withColumn(_Y, F.when(F.col("_bundle_ok"), F.col("prediction").cast("int")))
        return self.labels.decode(scored, _Y, out).select(*df.columns, out)

    def save(self, path: str) -> str:
        spark = self.labels.table.sparkSession
        save_model(self.model, f"{path}/model")
        self.labels.save(f"{path}/labels")
        self.scaler.save(spark, f"{path}/scaler")
        doc = json.dumps({"cols": self.cols, "name": self.name})
        spark.createDataFrame([(doc,)], "doc string").coalesce(1).write.mode("overwrite").text(f"{path}/bundle")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ModelBundle":
        doc = json.loads(spark.read.text(f"{path}/bundle").first()[0])
        return cls(load_model(f"{path}/model"), LabelEncoderModel.load(spark, f"{path}/labels"),
                   ScalerModel.load(spark, f"{path}/scaler"), doc["cols"], doc["name"])


def fit_bundle(train: DataFrame, cols: Sequence[str], label: str, name: str = "logistic", scaler: str = "standard",
               seed: int = 42) -> ModelBundle:
    """Fit dictionary, scaler and model on the rows that have a label and all features."""
    bundle = ModelBundle(None, None, None, cols, name)
    rows = train.select(*cols, label).where(F.col(label).isNotNull() & bundle._complete())
    bundle.scaler = Scaler(scaler, cols).fit(rows)
    bundle.labels = LabelEncoder(label, _Y).fit(rows)
    bundle.model, _ = M.fit_model(name, bundle._scaled(bundle.labels.transform(rows)).select(_X, _Y), _X, _Y, seed)
    return bundle
