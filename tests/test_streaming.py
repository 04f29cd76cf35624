import os
from decimal import Decimal

from emulator import Emulator
from records import frame, random_records

from strandweave import SegmentStore, card_profile, load_batch, open_model
from strandweave.streaming import (
    changes, current_totals, first_keys, latest_totals, list_items, load_stream, running_totals, vacuum_changes, write_changes, write_totals,
)
from pyspark.sql import functions as F


def drop(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def test_running_totals_over_batches(spark, workspace):
    folder, out, checkpoint = (workspace.folder(name) for name in ("in", "out", "checkpoint"))
    batches = [[("a", 1), ("b", 2), ("a", 3)], [("a", 10)], [("c", 5), ("b", -2)]]
    for rows in batches:
        drop(spark.createDataFrame(rows, "k string, v long"), folder)
        stream = spark.readStream.schema("k string, v long").parquet(folder)
        write_totals(running_totals(stream, "k", F.col("v")), out, checkpoint).awaitTermination()
    assert {tuple(r) for r in latest_totals(spark, out, "k").collect()} == {("a", 14), ("b", 0), ("c", 5)}
    # Only changed totals are written: the second batch has one row.
    assert spark.read.parquet(out).where("batch = 1").count() == 1


def test_totals_follow_updates_and_moves(spark, workspace):
    folder, out, checkpoint = (workspace.folder(name) for name in ("in", "out", "checkpoint"))
    schema = "k string, at long, g string, v decimal(10,2)"
    batches = [
        [("a", 1, "x", 10), ("b", 1, "x", 5), ("a", 3, "x", 7), (None, 1, "x", 99)],
        [("a", 2, "z", 100), ("b", 2, "y", 6)],  # a's change comes too late; b moves from x to y
        [("a", 4, "x", -1), ("c", 1, None, 2), ("c", 2, None, None)],
        [("b", 3, "y", 1)],
        [("a", 5, "y", 2)],  # the last row leaves x
    ]
    last, wanted = {}, []
    for rows in batches:
        for k, at, g, v in rows:
            if k is not None and at > last.get(k, (0,))[0]:
                last[k] = at, g, v or 0
        totals = {}
        for _, g, v in last.values():
            totals[g] = (totals.get(g, (0, 0))[0] + v, totals.get(g, (0, 0))[1] + 1)
        wanted.append(totals)
    for rows, totals in zip(batches, wanted):
        drop(spark.createDataFrame([(k, at, g, None if v is None else Decimal(v)) for k, at, g, v in rows], schema), folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        write_changes(changes(stream, "k", "at", "g", F.col("v")), out, checkpoint, fold=2).awaitTermination()
        assert {r.group: (r.total, r.rows) for r in current_totals(spark, out).collect()} == totals
    vacuum_changes(spark, out)
    assert {r.group: (r.total, r.rows) for r in current_totals(spark, out).collect()} == wanted[-1] == {"y": (3, 2), None: (0, 1)}
    # Sums replace what they hold: two batches of changes are left, the one the sums end with and the last.
    assert len(os.listdir(f"{out}/changes")) == 2 and len(os.listdir(f"{out}/sums")) == 1


def run(frame, workspace, checkpoint, out):
    writer = frame.writeStream.option("checkpointLocation", checkpoint).option("path", out).format("parquet")
    writer.trigger(availableNow=True).start().awaitTermination()


def test_keys_and_items_are_emitted_once(spark, workspace):
    folder, out, checkpoint = (workspace.folder(name) for name in ("in", "out", "checkpoint"))
    for texts in (["a, b", None, "b"], ["b ,c", "a,"], ["c"]):
        drop(spark.createDataFrame([(t,) for t in texts], "t string"), folder)
        stream = spark.readStream.schema("t string").parquet(folder)
        run(first_keys(list_items(stream, "t"), "item"), workspace, checkpoint, out)
    assert sorted(r.item for r in spark.read.parquet(out).collect()) == ["", "a", "b", "c"]


def test_keys_within_watermark(spark, workspace):
    folder, out, checkpoint = (workspace.folder(name) for name in ("in", "out", "checkpoint"))
    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:01:00"), ("b", "2024-01-01 00:02:00")]
    drop(spark.createDataFrame(rows, "k string, t string").withColumn("t", F.col("t").cast("timestamp_ntz")), folder)
    stream = spark.readStream.schema("k string, t timestamp_ntz").parquet(folder)
    run(first_keys(stream, "k", "t", "10 minutes"), workspace, checkpoint, out)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_stream_load_equals_batch_load(spark, workspace):
    records = random_records(60, seed=5)
    folder, checkpoint = workspace.folder("in"), workspace.folder("checkpoint")
    store = SegmentStore(spark, workspace.folder("store"))
    for start in (0, 25):
        part = records[:25] if start == 0 else records[25:]
        rows = frame(spark, part, start=start)
        drop(rows, folder)
        load_stream(spark.readStream.schema(rows.schema).parquet(folder), store, checkpoint).awaitTermination()
    whole = SegmentStore(spark, workspace.folder("whole"))
    load_batch(whole, frame(spark, records), workspace)
    streamed, loaded = (sorted(map(repr, card_profile(open_model(spark, s)).collect())) for s in (store, whole))
    assert streamed == loaded and len(loaded) == len(Emulator().load(records).cards)
    # Batches are named by the query's id, which a restart from the checkpoint keeps.
    first, second = (name.rsplit("-", 1) for name in store.manifest()["batches"])
    assert first[0] == second[0] != "None" and (first[1], second[1]) == ("0", "1")
