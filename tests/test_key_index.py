"""Stored keys by bucket: what a batch reads, and that what it finds is right."""

from pyspark.sql import functions as F
from records import frame, random_records

from strandweave import SegmentStore, card_profile, load_batch, open_model
from strandweave.operators.key_index import CARD_SPACE, INDEX, INDEX_SCHEMA, bucket_of
from strandweave.plans.load import compact_model, stored_index
from strandweave.plans.schema import TABLES


def loaded(spark, workspace, parts, **options):
    store, start = SegmentStore(spark, workspace.folder("store")), 0
    for part in parts:
        load_batch(store, frame(spark, part, start=start), workspace, **options)
        start += len(part)
    return store


def contents(store):
    model = open_model(store.spark, store)
    return {name: sorted(map(repr, model[name].collect())) for name in TABLES}


def test_index_changes_no_result(spark, workspace):
    records = random_records(120, seed=9)
    parts = [records[:50], records[50:]]
    with_index = loaded(spark, workspace, parts, key_buckets=7)
    without = loaded(spark, workspace, parts, key_buckets=0)
    assert contents(with_index) == contents(without)
    assert with_index.manifest()["key_buckets"] == 7 and stored_index(without, without.manifest()) is None
    before = contents(with_index)["card"]
    compact_model(with_index)
    load_batch(with_index, frame(spark, records[:60], start=500), workspace)  # nothing but repeats
    assert contents(with_index)["card"] == before


def test_index_holds_every_key_once(spark, workspace):
    records = random_records(80, seed=3)
    store = loaded(spark, workspace, [records[:40], records[20:]])
    rows = store.read(store.manifest(), INDEX, INDEX_SCHEMA)
    assert rows.groupBy("space", "key").count().where("count > 1").count() == 0
    assert rows.where(F.col("bucket") != bucket_of("space", "key", 64)).count() == 0
    model = open_model(spark, store)
    assert sorted(r.key for r in rows.where(F.col("space") == CARD_SPACE).collect()) == sorted(r.card_uuid for r in model["card"].collect())
    for table, key in (("artist", "artist_name"), ("mana_cost", "mana_cost_text"), ("card_type", "card_type_name"), ("mana_pip", "mana_pip_symbol")):
        wanted = sorted(r[0] for r in model[table].select(key).where(F.col(key).isNotNull()).collect())
        assert sorted(r.key for r in rows.where(F.col("space") == table).collect()) == wanted, table


def test_one_record_reads_one_bucket(spark, workspace):
    store = loaded(spark, workspace, [random_records(200, seed=1)])
    index = stored_index(store, store.manifest())
    wanted = spark.createDataFrame([(CARD_SPACE, "some-uuid")], "space string, key string")
    near = index.near(wanted)
    assert len(index.touched(wanted)) == 1
    text = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in text and "ReadSchema: struct<space:string,key:string,id:bigint>" in text
    read = {r[0].split("bucket=")[1].split("/")[0] for r in near.select(F.input_file_name()).distinct().collect()}
    assert read == {str(b) for b in index.touched(wanted)}
    every = {r[0] for r in index.rows.select("bucket").distinct().collect()}
    assert len(every) > 40


def test_a_batch_reads_only_its_buckets(spark, workspace, monkeypatch):
    records = random_records(200, seed=2)
    store = loaded(spark, workspace, [records[:-1]])
    from strandweave.operators import key_index

    seen, near = [], key_index.KeyIndex.near
    monkeypatch.setattr(key_index.KeyIndex, "near", lambda self, keys: seen.append(self.touched(keys)) or near(self, keys))
    scanned, read = [], SegmentStore.read
    monkeypatch.setattr(SegmentStore, "read", lambda self, manifest, table, schema: scanned.append(table) or read(self, manifest, table, schema))
    load_batch(store, frame(spark, records[-1:], start=199), workspace)
    assert seen and any(len(touched) == 1 for touched in seen) and all(len(touched) < 64 for touched in seen)
    assert INDEX in scanned
    assert card_profile(open_model(spark, store)).count() == len({r["uuid"] for r in records})
