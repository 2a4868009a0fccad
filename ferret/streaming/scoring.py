"""Apply a fitted cleaning model to a stream.

The reference has no streaming code.  What carries over is that a fitted
``CleaningModel`` transform is a pure projection (literals and lookups, no
aggregation), so the same code scores an unbounded table: each micro-batch is
imputed, power-transformed, target-encoded and HBOS-scored with the
train-fitted parameters, without state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def score_stream(model, stream: DataFrame) -> DataFrame:
    """Streaming DataFrame of transformed rows (no target needed)."""
    if not stream.isStreaming:
        raise ValueError("score_stream expects a streaming DataFrame")
    return model.score_new(stream)


def start_scoring(model, stream: DataFrame, path: str, checkpoint: str,
                  available_now: bool = True) -> StreamingQuery:
    """Write scored rows as parquet with exactly-once file sink semantics."""
    w = (score_stream(model, stream).writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
