"""Totals per group that follow changes of rows: a row that is updated or moves takes its old value back.

The state of a row key is what the row said last: its place in the order of changes, its group
and its value.  A later change emits minus the old value for the old group and plus the new one
for the new group, so a moved row lowers the group it leaves; an earlier change that comes late
emits nothing.  Every batch's changes are summed by group before they are written, and every
``fold`` batches the sums so far are written as one table, so neither readers nor folders grow
with the number of batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

FOLD = 32
CHANGES = "group string, change bigint, rows bigint"
_STATE = "place bigint, group string, value bigint"


def _follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    old = state.get if state.exists else None
    new = old
    for frame in frames:  # a popular key comes in several frames; only its last change is kept
        row = frame.loc[frame["place"].idxmax()]
        if new is None or int(row["place"]) > new[0]:
            new = int(row["place"]), None if pd.isna(row["group"]) else str(row["group"]), int(row["value"])
    if new is not None and new is not old:
        state.update(new)
        rows = [] if old is None else [(old[1], -old[2], -1)]
        yield pd.DataFrame([*rows, (new[1], new[2], 1)], columns=["group", "change", "rows"])


def changes(stream: DataFrame, key: str, place: str, group: str, value: Column, scale: int = 4) -> DataFrame:
    """(group, change, rows) of every changed row of a stream of inserts and updates; write it in update mode.

    ``place`` orders the changes of a key and is theirs alone.  ``value`` counts in units of
    10^-``scale``, so sums are exact whatever their order; a null one adds nothing.  Rows without
    key or place take no part.
    """
    units = F.round(F.coalesce(value, F.lit(0)) * F.lit(10 ** scale)).cast("bigint")
    rows = stream.select(F.col(key).alias("key"), F.col(place).cast("bigint").alias("place"), F.col(group).cast("string").alias("group"), units.alias("value"))
    placed = rows.where("key IS NOT NULL AND place IS NOT NULL")
    return placed.groupBy("key").applyInPandasWithState(_follow, CHANGES, _STATE, "update", GroupStateTimeout.NoTimeout)


def batch_folder(path: str, kind: str, number: int) -> str:
    return f"{path}/{kind}/batch={number}"


def written_batches(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the batches that were written to the end."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    paths = [status.getPath() for status in files.listStatus(folder)]
    return sorted(int(p.getName()[6:]) for p in paths if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("group").agg(F.sum("change").alias("change"), F.sum("rows").alias("rows"))


def folders_before(spark: SparkSession, path: str, number: int, whole: str = "sums", part: str = "changes") -> tuple[list[str], int]:
    """Folders that hold all there was before batch ``number``: the last sums and what came after them."""
    folds = [n for n in written_batches(spark, path, whole) if n < number]
    base = folds[-1] if folds else -1
    later = [batch_folder(path, part, n) for n in written_batches(spark, path, part) if base < n < number]
    return [batch_folder(path, whole, base)] * bool(folds) + later, base


def write_changes(stream: DataFrame, path: str, checkpoint: str, fold: int = FOLD, **trigger) -> StreamingQuery:
    """Write each batch's changes by group; a batch run again overwrites its folder."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        _summed(batch).write.mode("overwrite").parquet(batch_folder(path, "changes", number))
        if number % fold == fold - 1:
            folders, _ = folders_before(spark, path, number)
            _summed(spark.read.schema(CHANGES).parquet(*folders, batch_folder(path, "changes", number))).write.mode("overwrite").parquet(batch_folder(path, "sums", number))

    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start()


def current_totals(spark: SparkSession, path: str, scale: int = 4) -> DataFrame:
    """(group, total, rows) as of the last batch; a group that all its rows have left is gone."""
    folders, _ = folders_before(spark, path, 1 << 62)
    rows = spark.read.schema(CHANGES).parquet(*folders) if folders else spark.createDataFrame([], CHANGES)
    total = (F.col("change").cast("decimal(38,0)") / F.lit(10 ** scale)).cast(f"decimal(38,{scale})")
    return _summed(rows).where("rows > 0").select("group", total.alias("total"), "rows")


def vacuum_changes(spark: SparkSession, path: str) -> None:
    """Delete folders that the last sums hold already, but for the batch they end with; no reader may be using them."""
    _, base = folders_before(spark, path, 1 << 62)
    for kind in ("changes", "sums"):
        for number in written_batches(spark, path, kind):
            if number < base:
                folder = spark._jvm.org.apache.hadoop.fs.Path(batch_folder(path, kind, number))
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
