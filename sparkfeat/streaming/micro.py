from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate as V
from ..sources import files as S


def score_stream(stream: DataFrame, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a row-wise fitted transform (scaler, encoder, quantizer, model) to a
    streaming DataFrame; nothing is kept across micro-batches."""
    return transform(stream)


def append_batch_metrics(scored: DataFrame, path: str, label: str = "label", pred: str = "pred",
                         checkpoint: str | None = None, trigger_once: bool = True):
    """Start a query that appends accuracy and weighted P/R/F1 of every
    micro-batch (with its batch id) to the metric store at ``path``; a batch that is
    delivered again replaces its own record."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rec = V.weighted_prf(batch, label, pred).withColumn("batch_id", F.lit(batch_id).cast("long"))
        S.append_metrics(rec, path, f"batch-{batch_id}")

    w = scored.writeStream.foreachBatch(write)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
