"""Categorical encoders.

* ``LabelEncoder``: ids 0..k-1 in sorted class order, kept as a dictionary table of any
  size and joined; an unseen label at transform time is an error.
* ``one_hot``: one int column per category value, originals dropped, none
  left out; the category list is bounded metadata collected once.
* ``frequency_encode``: the absolute count of the value, by a partial
  aggregation joined back (AQE broadcasts the per-value table when small).
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.order import global_index, total_rows
from ..session import materialize


class LabelEncoder:
    def __init__(self, col: str, out: str | None = None):
        self.col, self.out = col, out or f"{col}_id"

    def fit(self, df: DataFrame) -> "LabelEncoderModel":
        """The dictionary: distinct labels, combined before the exchange, with their
        positions from the range-partitioned index; a written table, never the driver's."""
        labels = df.select(F.col(self.col).cast("string").alias("class_name")).where("class_name IS NOT NULL").distinct()
        ranked, sizes = global_index(labels, ["class_name"], rn="class_id")
        table = materialize(ranked.select(F.col("class_id").cast("int").alias("class_id"), "class_name"), "label-dictionary")
        return LabelEncoderModel(self.col, self.out, table, total_rows(sizes))


class LabelEncoderModel:
    """Labels and ids as a table (class_id, class_name) of ``n`` rows.

    Up to ``SMALL`` labels the table is broadcast; beyond, rows meet it in a join that
    adaptive execution splits where a label is hot."""

    SMALL = 100_000

    def __init__(self, col: str, out: str, table: DataFrame, n: int):
        self.col, self.out, self.table, self.n = col, out, table, n

    @property
    def classes(self):
        """The labels in order of their ids, for dictionaries of at most ``SMALL``."""
        if self.n > self.SMALL:
            raise ValueError(f"{self.n} labels: use class_table")
        return [r["class_name"] for r in self.table.orderBy("class_id").collect()]

    def _side(self, key: str, value: str) -> DataFrame:
        side = self.table.select(F.col(key).alias("_label_key"), F.col(value).alias("_label_value"))
        return F.broadcast(side) if self.n <= self.SMALL else side

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the id; a label that was not fitted, or none, is an error."""
        label = F.col(self.col).cast("string")
        out = df.withColumn(self.col, label).join(self._side("class_name", "class_id"), label == F.col("_label_key"), "left")
        unseen = F.raise_error(F.concat(F.lit(f"unseen label in column {self.col}: "), F.coalesce(label, F.lit("null")))).cast("int")
        return out.withColumn(self.out, F.coalesce(F.col("_label_value"), unseen)).drop("_label_key", "_label_value")

    def class_table(self, spark) -> DataFrame:
        """(class_id, class_name) (E5)."""
        return self.table

    def decode(self, df: DataFrame, id_col: str, out: str) -> DataFrame:
        """Class id back to its name (P11); null for an id that is none."""
        side = self._side("class_id", "class_name")
        return (df.join(side, F.col(id_col) == F.col("_label_key"), "left")
                  .withColumn(out, F.col("_label_value")).drop("_label_key", "_label_value"))

    def save(self, path: str) -> None:
        self.table.withColumns({"col": F.lit(self.col), "out": F.lit(self.out)}).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str) -> "LabelEncoderModel":
        table = spark.read.parquet(path)
        head = table.select("col", "out", F.lit(1)).first()
        if head is None:
            raise ValueError(f"no labels in {path}")
        return LabelEncoderModel(head["col"], head["out"], table.select("class_id", "class_name"), table.count())


def one_hot(df: DataFrame, col: str, values: Sequence | None = None, drop: bool = True,
            max_values: int = 1_000) -> DataFrame:
    """``{col}_{value}`` int columns for every value, in sorted value order.

    Every value is a column of the plan, so more than ``max_values`` are refused."""
    if values is None:
        values = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)
                  .limit(max_values + 1).collect()]
    if len(values) > max_values:
        raise ValueError(f"column {col} has more than {max_values} values; one column each is too wide a table")
    out = df.withColumns({f"{col}_{v}": (F.col(col) == F.lit(v)).cast("int") for v in values})
    return out.drop(col) if drop else out


def frequency_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Replace a category by the number of rows holding it.

    The per-value counts come from a partial aggregation (map-side combine),
    so a hot value costs one row per task before the shuffle.
    """
    out = out or col
    freq = df.groupBy(col).agg(F.count(F.lit(1)).alias("__freq"))
    res = df.join(freq, col, "left")
    if out == col:
        return res.withColumn(col, F.col("__freq")).drop("__freq")
    return res.withColumnRenamed("__freq", out)


def bool_to_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Boolean columns to 0/1 int."""
    return df.withColumns({c: F.col(c).cast("int") for c in cols})
