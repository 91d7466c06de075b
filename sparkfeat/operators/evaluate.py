"""Classification metrics from a prediction table.

Everything starts from one grouped count over (label, prediction) - a table
of at most k^2 rows - so the cost is one pass over the predictions no matter
how many metrics are derived.  Classes are the union of true and predicted
values; zero_division gives 0.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _pairs(pred: DataFrame, label: str, p: str, by: Sequence[str]) -> DataFrame:
    return pred.groupBy(*by, F.col(label).alias("y"), F.col(p).alias("yhat")).agg(F.count(F.lit(1)).alias("n"))


def per_class(pred: DataFrame, label: str = "label", p: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """(by, class, tp, support, predicted, precision, recall, f1)."""
    by = list(by)
    pairs = _pairs(pred, label, p, by)
    true = pairs.groupBy(*by, F.col("y").alias("class")).agg(F.sum("n").alias("support"))
    predicted = pairs.groupBy(*by, F.col("yhat").alias("class")).agg(F.sum("n").alias("predicted"))
    tp = pairs.where(F.col("y") == F.col("yhat")).groupBy(*by, F.col("y").alias("class")).agg(F.sum("n").alias("tp"))
    t = (true.join(predicted, by + ["class"], "full").join(tp, by + ["class"], "left")
             .fillna(0, ["support", "predicted", "tp"]))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    t = t.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    return t.withColumn("f1", f1).select(*by, "class", F.col("tp").cast("long"), F.col("support").cast("long"),
                                          F.col("predicted").cast("long"), "precision", "recall", "f1")


def accuracy(pred: DataFrame, label: str = "label", p: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Share of rows with prediction == label (V1)."""
    return pred.groupBy(*by).agg(F.avg((F.col(label) == F.col(p)).cast("double")).alias("accuracy"))


def weighted_prf(pred: DataFrame, label: str = "label", p: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall, F1 (V1-V4)."""
    by = list(by)
    pc = per_class(pred, label, p, by)
    return pc.groupBy(*by).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"))


def confusion(pred: DataFrame, label: str = "label", p: str = "pred") -> DataFrame:
    """(label, pred, count) for every pair of classes, zero cells included (V5)."""
    pairs = _pairs(pred, label, p, [])
    # the class list (k values) as one array; the k x k cells are generated from it
    classes = (pairs.select(F.col("y").alias("c")).union(pairs.select(F.col("yhat").alias("c")))
                    .agg(F.array_sort(F.collect_set("c")).alias("cs")))
    grid = classes.select(F.explode("cs").alias("y"), "cs").select("y", F.explode("cs").alias("yhat"))
    return (grid.join(pairs, ["y", "yhat"], "left")
                .select(F.col("y").alias(label), F.col("yhat").alias(p),
                        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("count")))


def class_report(pred: DataFrame, label: str = "label", p: str = "pred") -> DataFrame:
    """Per-class precision/recall/F1/support plus accuracy, macro and weighted rows (V6)."""
    pc = per_class(pred, label, p)
    rows = pc.select(F.col("class").cast("string").alias("row"), "precision", "recall", "f1", "support")
    tot = pc.agg(F.sum("tp").alias("tp"), F.sum("support").alias("n"),
                 F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                 (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                 (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                 (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    summary = tot.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("n")).alias("f1"),
                 F.col("n").cast("long").alias("support")),
        F.struct(F.lit("macro avg").alias("row"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("n").cast("long").alias("support")),
        F.struct(F.lit("weighted avg").alias("row"), F.col("wp").alias("precision"), F.col("wr").alias("recall"),
                 F.col("wf").alias("f1"), F.col("n").cast("long").alias("support")))))
    return rows.unionByName(summary)


def log_loss(pred: DataFrame, p_true: str = "p_true", eps: float = 1e-15) -> DataFrame:
    """Mean cross-entropy -ln p[label] (M11), p clipped at ``eps``."""
    return pred.agg(F.avg(-F.log(F.greatest(F.col(p_true), F.lit(eps)))).alias("log_loss"),
                    F.count(F.lit(1)).alias("n"))


def metric_table(long_pred: DataFrame, model: str = "model", label: str = "label", p: str = "pred") -> DataFrame:
    """One row per model: accuracy, weighted precision, recall, F1 (V7)."""
    return weighted_prf(long_pred, label, p, [model])


def unpivot_metrics(df: DataFrame, id_cols: Sequence[str], metrics: Sequence[str], digits: int = 4) -> DataFrame:
    """(id, metric, value) with half-even rounding to ``digits``."""
    return (df.unpivot(list(id_cols), list(metrics), "metric", "value")
              .withColumn("value", F.bround(F.col("value").cast("double"), digits)))


def best_row(df: DataFrame, metric: str, tie: str) -> DataFrame:
    """Row with the highest metric, first ``tie`` on ties."""
    return df.orderBy(F.desc(metric), F.asc(tie)).limit(1)


def relative_change(df: DataFrame, key: str, baseline: str, cols: Sequence[str]) -> DataFrame:
    """Per row: percent change of each column against the baseline row.

    ``{c}_change_pct`` = 100 (x - base) / base, ``{c}_change_pts`` = 100 (x - base):
    percentage points of measures on a scale from 0 to 1.  The baseline is a single row (filtered by key), broadcast to every row.
    """
    base = df.where(F.col(key) == F.lit(baseline)).select(*cols).first()  # the one baseline row
    if base is None:
        raise ValueError(f"no baseline row {baseline!r}")
    out = df
    for c in cols:
        b = base[c]
        out = out.withColumn(f"{c}_change_pct",
                             (100.0 * (F.col(c) - F.lit(b)) / F.lit(b)) if b else F.lit(None).cast("double"))
        out = out.withColumn(f"{c}_change_pts", 100.0 * (F.col(c) - F.lit(b)))
    return out


# Flash size (KB) of the target boards in the reference's
# deployment check, in its order.
DEVICE_FLASH_KB = [
    ("Arduino Nano 33 BLE Sense", 1024),
    ("ESP32", 4096),
    ("Raspberry Pi Pico", 2048),
    ("STM32", 1024),
]


def fit_limits(sizes: DataFrame, size_kb: str, limits=DEVICE_FLASH_KB) -> DataFrame:
    """Every (row, device) pair: 'Suitable' when size <= flash.

    The device list is a fixed small table; it is expanded per row with a
    generator, not joined.
    """
    devs = F.array(*[F.struct(F.lit(d).alias("device"), F.lit(int(kb)).alias("flash_kb")) for d, kb in limits])
    return (sizes.select("*", F.inline(devs))
                 .withColumn("status", F.when(F.col(size_kb) <= F.col("flash_kb"), F.lit("Suitable"))
                             .otherwise(F.lit("Not Suitable"))))
