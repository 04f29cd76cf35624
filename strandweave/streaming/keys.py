"""Items and keys from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strandweave.functions import list_tokens


def list_items(stream: DataFrame, column: str, item: str = "item") -> DataFrame:
    """One row per item of a delimited column; needs no state."""
    others = [name for name in stream.columns if name != column]
    return stream.select(*others, F.explode(list_tokens(F.col(column))).alias(item))


def first_keys(stream: DataFrame, key: str, event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """Emit each key once.

    With ``event_time`` and ``delay`` a key is forgotten once the watermark passes, which
    bounds the state; without them every key is remembered.
    """
    if event_time is None:
        return stream.select(key).where(F.col(key).isNotNull()).dropDuplicates([key])
    timed = stream.select(key, F.col(event_time).cast("timestamp").alias(event_time)).where(F.col(key).isNotNull())
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
