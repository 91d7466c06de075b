"""Micro-batch application of fitted transforms and the metric store.

The reference has no streams: every read is a full eager file read.  The one
place where rows arrive over time is scoring; ``score_stream`` applies any
fitted sparkfeat / pyspark.ml transform to a Structured Streaming source
(stateless per micro-batch) and ``append_batch_metrics`` appends one metric
record per micro-batch to the parquet metric store (S5) via ``foreachBatch``.
"""
from .micro import append_batch_metrics, score_stream  # noqa: F401
