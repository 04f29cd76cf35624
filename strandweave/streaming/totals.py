"""Running totals per key, kept up to date by arriving rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


def running_totals(stream: DataFrame, key: str, value: Column, total: str = "total") -> DataFrame:
    """Streaming sum per key. Each task sums its rows first, so a hot key reaches its state
    as one row per task. Write it in update mode: a batch emits just the changed totals."""
    return stream.groupBy(key).agg(F.sum(value).alias(total))


def write_totals(totals: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write each batch's changed totals to its own folder; a batch run again overwrites it."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start()


def latest_totals(spark: SparkSession, path: str, key: str, total: str = "total") -> DataFrame:
    """Current total of every key: the one of its last batch."""
    written = spark.read.parquet(path)
    return written.groupBy(key).agg(F.max_by(total, F.col("batch").cast("long")).alias(total))
