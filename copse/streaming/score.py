"""Scoring rows as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.boost import BoostedModel


def score_stream(stream: DataFrame, model: BoostedModel, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Score a streaming frame into Parquet, exactly once by way of the checkpoint.

    Scoring is one projection without state, so it needs no watermark and
    survives restarts. ``once`` stops after the rows that are there now.
    """
    writer = model.predict_proba(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.option("path", out).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
