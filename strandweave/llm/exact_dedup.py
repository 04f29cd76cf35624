"""Exact duplicates by a stateful stream: one disk-backed entry per digest, never expired.

A pass over the documents leaves digest, length, id and locator of each; these small rows are
streamed into an aggregate whose state lies in RocksDB and holds, per digest, the row that
stays (its id and the place of its text) and the number of rows seen.  Then the whole texts of
all hits are compared byte by byte.  Should texts of one digest differ, their rows are grouped
by the texts themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from strandweave.llm.common import BLANKS, located, settings, text_or_empty
from strandweave.operators.lookup import Lookup, attach
from strandweave.tables import Workspace

STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Many small stores: each would otherwise lay claim to 4 MB of disk before it holds anything.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normal_text(text: Column) -> Column:
    """``text`` without its blanks; null is empty."""
    return F.regexp_replace(text_or_empty(text), f"[{BLANKS}]+", "")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _first() -> Column:
    """Greater for the row that stays: most code points, then smallest id, null last."""
    return F.struct("n_chars", F.col("doc_id").isNotNull().alias("has_id"), F.bitwise_not("doc_id").alias("inverse_id"), "file", "row", "doc_id")


def stream_groups(seen: DataFrame, folder: str, workspace: Workspace, files_per_batch: int) -> DataFrame:
    """Stream the rows written in ``folder`` through the keyed state; one row per digest."""
    spark = seen.sparkSession
    emitted = workspace.folder("state")
    arriving = spark.readStream.schema(seen.schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    state = arriving.groupBy("digest").agg(F.max(_first()).alias("best"), F.count(F.lit(1)).alias("group_size"))

    def keep(changes: DataFrame, batch: int) -> None:
        # A batch that runs again replaces what it wrote.
        changes.select("digest", "best", "group_size").write.mode("overwrite").parquet(f"{emitted}/batch={batch}")

    with settings(spark, STATE):  # a stream takes them over as it starts
        query = (
            state.writeStream.outputMode("update").foreachBatch(keep).trigger(availableNow=True)
            .option("checkpointLocation", workspace.folder("stream")).start()
        )
    query.awaitTermination()
    empty = seen.where("false").groupBy("digest").agg(F.max(_first()).alias("best"), F.count(F.lit(1)).alias("group_size"))
    if not query.recentProgress or query.lastProgress is None or seen.isEmpty():
        return empty
    # Entries only ever improve and counts only grow, so the last emission is the greatest.
    changes = spark.read.schema(empty.schema).parquet(f"{emitted}/batch=*")
    return changes.groupBy("digest").agg(F.max("best").alias("best"), F.max("group_size").alias("group_size"))


def exact_groups(docs: DataFrame, workspace: Workspace, digest: Callable[[Column], Column] = sha256,
                 files_per_batch: int = 1000) -> DataFrame:
    """One row per document: file, row, doc_id, digest, keep_id, group_size, kept.

    A null text counts as empty, and all empty texts are equal.  Rows without an id stay only
    if no equal text has one; of rows that repeat entirely exactly one stays.  An empty table
    gives no rows.  ``docs`` needs ``doc_id`` and ``text``; other columns are not read.
    """
    return _groups(located(docs, workspace), workspace, digest, files_per_batch)


def _groups(source: DataFrame, workspace: Workspace, digest: Callable[[Column], Column], files_per_batch: int) -> DataFrame:
    spark = source.sparkSession
    text = F.col("doc.text")
    folder = workspace.folder("seen")
    source.select(
        digest(normal_text(text)).alias("digest"), F.char_length(text_or_empty(text)).cast("long").alias("n_chars"),
        F.col("doc.doc_id").cast("long").alias("doc_id"), "file", "row",
    ).write.parquet(folder)
    seen = spark.read.parquet(folder)
    state = stream_groups(seen, folder, workspace, files_per_batch)
    repeated = workspace.save(state.where("group_size > 1").select(
        "digest", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.file").alias("keep_file"), F.col("best.row").alias("keep_row")), "groups")
    values = ["group_size", "keep_id", "keep_file", "keep_row"]
    joined = attach(seen, [Lookup(repeated, "digest", "digest", {v: v for v in values})], "row")
    single = F.col("group_size").isNull()
    rows = workspace.write(joined.select(
        "file", "row", "doc_id", "n_chars", "digest",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (single | ((F.col("keep_file") == F.col("file")) & (F.col("keep_row") == F.col("row")))).alias("kept"),
    ), "rows")

    # Full bytes of every hit, met by locator (no key repeats); the least and the greatest text of
    # a digest are found in the tasks first, so a large group sends one row per task.
    hits = rows.where("group_size > 1").select("file", "row", "digest")
    texts = source.select("file", "row", normal_text(text).alias("normal")).join(hits, ["file", "row"])
    unequal = texts.groupBy("digest").agg(F.min("normal").alias("least"), F.max("normal").alias("greatest")).where("least <> greatest")
    clashes = workspace.save(unequal.select("digest"), "clashes")
    if not clashes.rows:
        return rows.drop("n_chars")
    marked = attach(rows, [Lookup(clashes_with_mark(clashes), "digest", "digest", {"clash": "clash"})], "row")
    apart = marked.where(F.col("clash")).select("file", "row", "doc_id", "n_chars", "digest")
    own = source.select("file", "row", normal_text(text).alias("normal")).join(apart, ["file", "row"])
    own = workspace.write(own, "clashing_texts")
    classes = own.groupBy("digest", "normal").agg(F.max(_first()).alias("best"), F.count(F.lit(1)).alias("group_size"))
    settled = own.join(classes, ["digest", "normal"]).select(
        "file", "row", "doc_id", "digest", F.col("best.doc_id").alias("keep_id"), "group_size",
        ((F.col("best.file") == F.col("file")) & (F.col("best.row") == F.col("row"))).alias("kept"))
    return marked.where(F.col("clash").isNull()).drop("clash", "n_chars").unionByName(settled)


def clashes_with_mark(clashes):
    return clashes.with_df(clashes.df.withColumn("clash", F.lit(True)))


def drop_exact_duplicates(docs: DataFrame, workspace: Workspace, **options) -> DataFrame:
    """``docs``, all columns kept, without the rows that an equal text makes superfluous."""
    source = located(docs, workspace)
    rows = _groups(source, workspace, options.get("digest", sha256), options.get("files_per_batch", 1000))
    dropped = rows.where(~F.col("kept")).select("file", "row")
    return source.join(dropped, ["file", "row"], "left_anti").select("doc.*")
