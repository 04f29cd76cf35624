"""List items of a stream become bridge rows with ids."""

from strandweave.streaming import item_bridge, item_keys, write_item_bridge
from strandweave.streaming.updates import batch_folder

SCHEMA = "row_ord long, types string"
BATCHES = [[(3, "b, a ,b"), (4, None), (5, "")], [(6, "a,c"), (7, "c")], [(1, "c,d")]]


def run(spark, workspace, fold):
    incoming, path, checkpoint = (workspace.folder(n) for n in ("incoming", "bridge", "checkpoint"))
    for rows in BATCHES:
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(incoming)
        stream = spark.readStream.schema(SCHEMA).parquet(incoming)
        write_item_bridge(stream, "types", path, checkpoint, fold=fold).awaitTermination()
    return path


def named(spark, path):
    names = {row.id: row.key for row in item_keys(spark, path).collect()}
    return sorted((row.owner, names[row.item_id]) for row in item_bridge(spark, path).collect())


WANTED = [(1, "c"), (1, "d"), (3, "a"), (3, "b"), (5, ""), (6, "a"), (6, "c"), (7, "c")]


def test_ids_over_batches(spark, workspace):
    path = run(spark, workspace, fold=2)
    assert named(spark, path) == WANTED
    ids = {row.key: row.id for row in item_keys(spark, path).collect()}
    assert ids == {"b": 3 << 20, "a": (3 << 20) + 1, "": 5 << 20, "c": (6 << 20) + 1, "d": (1 << 20) + 1}  # a stored id stays
    assert item_bridge(spark, workspace.folder("none")).count() == 0


def test_a_batch_delivered_again(spark, workspace):
    """A fresh checkpoint gives the first batch its number again: it overwrites what it wrote."""
    path = run(spark, workspace, fold=32)
    before = sorted(map(tuple, spark.read.parquet(batch_folder(path, "bridge", 0)).collect()))
    incoming = workspace.folder("incoming")
    spark.createDataFrame(BATCHES[0], SCHEMA).write.parquet(incoming)
    write_item_bridge(spark.readStream.schema(SCHEMA).parquet(incoming), "types", path, workspace.folder("checkpoint")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(batch_folder(path, "bridge", 0)).collect())) == before
    assert named(spark, path) == WANTED
