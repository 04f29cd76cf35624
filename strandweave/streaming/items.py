"""List items of a stream as bridge rows, with ids from a dictionary that the stream fills itself.

A batch's items meet the keys that earlier batches stored; new ones get the place where they are
first seen as their id, as in a load, and are stored for later batches.  Every ``fold`` batches
all keys so far are written as one table.  A batch that is run again reads only what came before
it and overwrites its own folders, so bridge rows come out once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from strandweave.fixed import ROW_ORD
from strandweave.functions.ordinals import POSITION_BITS, first_seen_id
from strandweave.operators.dimensions import list_rows
from strandweave.operators.lookup import Lookup, attach
from strandweave.streaming.updates import FOLD, batch_folder, folders_before, written_batches
from strandweave.tables import Workspace

KEYS = "key string, id long"
BRIDGE = "owner long, item_id long"
LAST = 1 << 62


def _keys(spark: SparkSession, path: str, before: int) -> DataFrame:
    folders, _ = folders_before(spark, path, before, "all_keys", "new_keys")
    return spark.read.schema(KEYS).parquet(*folders) if folders else spark.createDataFrame([], KEYS)


def write_item_bridge(stream: DataFrame, column: str, path: str, checkpoint: str, position_bits: int = POSITION_BITS,
                      fold: int = FOLD, **trigger) -> StreamingQuery:
    """Write (owner, item_id) of a delimited column below ``path``; a record's ordinal is its owner.

    The stream gives each record once.  Null cells give no rows, an item repeated in a cell one row.
    """

    def write(records: DataFrame, number: int) -> None:
        spark = records.sparkSession
        with Workspace(spark) as workspace:
            items = workspace.write(list_rows(records.select(ROW_ORD, column), {column: column}).select(ROW_ORD, "pos", "key"), "items")
            place = first_seen_id(F.col(ROW_ORD), F.col("pos"), position_bits)
            found = items.groupBy("key").agg(F.min(place).alias("id"))
            stored = _keys(spark, path, number)
            # Only keys of this batch are met with stored ones, and both are distinct, so no key is hot.
            met = workspace.save(found.join(stored.withColumnRenamed("id", "known"), "key", "left"), "met")
            met.df.where("known IS NULL").select("key", "id").write.mode("overwrite").parquet(batch_folder(path, "new_keys", number))
            ids = met.with_df(met.df.select(F.col("key").alias("name"), F.coalesce("known", "id").alias("item_id")))
            pairs = items.groupBy(F.col(ROW_ORD).alias("owner"), "key").agg(F.lit(1).alias("one")).select("owner", "key")
            bridge = attach(pairs, [Lookup(ids, "key", "name", {"item_id": "item_id"})], "owner").select("owner", "item_id")
            bridge.write.mode("overwrite").parquet(batch_folder(path, "bridge", number))
            if number % fold == fold - 1:
                _keys(spark, path, number + 1).write.mode("overwrite").parquet(batch_folder(path, "all_keys", number))

    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    return writer.foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start()


def item_keys(spark: SparkSession, path: str) -> DataFrame:
    """(key, id) of all items so far."""
    return _keys(spark, path, LAST)


def item_bridge(spark: SparkSession, path: str) -> DataFrame:
    """(owner, item_id) of all batches so far."""
    folders = [batch_folder(path, "bridge", number) for number in written_batches(spark, path, "bridge")]
    return spark.read.schema(BRIDGE).parquet(*folders) if folders else spark.createDataFrame([], BRIDGE)
