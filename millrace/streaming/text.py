"""Preparation on streams: the stateless stages as they are, dedup within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.plans.pipeline import Plan


def prepare_stream(df: DataFrame, plan: Plan, event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """A plan on a streaming frame.

    Dedup keeps the first *processed* row of each text. With ``event_time`` its state is dropped
    ``delay`` after the last row; without, it grows with the distinct texts, so give one.
    """
    from dataclasses import replace

    rows = replace(plan, dedup=False).stream(df)
    if not plan.dedup:
        return rows
    if event_time:
        return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([plan.text_column])
    return rows.dropDuplicates([plan.text_column])


def write_stream(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append to a Parquet directory; ``once`` takes what is there and stops."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
