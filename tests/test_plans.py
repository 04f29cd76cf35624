"""Physical plans have the shape they were written for."""

import re

import pytest
from records import frame, random_records

from strandweave import Load, SegmentStore, Workspace, card_profile, load_batch, open_model
from strandweave.operators.dimensions import first_places
from strandweave.plans.load import RECORD_TABLES
from strandweave.plans.schema import REFERENCES, TABLES, column_name, table_name


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def model(spark):
    workspace = Workspace(spark)
    store = SegmentStore(spark, workspace.folder("store"))
    load_batch(store, frame(spark, random_records(100)), workspace)
    return open_model(spark, store, workspace)


def test_profile_shuffles_by_card_only(model):
    text = plan(card_profile(model))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    keys = set(re.findall(r"Exchange hashpartitioning\((\w+)#", text))
    assert keys <= {"card_id"}, keys
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 4


def test_profile_reads_one_list_at_a_time(model):
    text = plan(card_profile(model))
    for table in ("card_type", "card_subtype", "card_supertype"):
        assert re.search(rf"PartitionFilters: \[isnotnull\(table#\d+\), \(table#\d+ = {table}\)\]", text), table
    assert "card_uuid" not in text  # unused columns are not read


def test_id_filter_reaches_the_scans(model):
    text = plan(card_profile(model).where("card_id = 3"))
    assert text.count("EqualTo(card_id,3)") >= 4


def test_unused_lists_are_dropped(model):
    assert "listagg" not in plan(card_profile(model).select("card_id", "cmc"))


def test_dictionary_uses_one_hash_aggregate(spark, workspace):
    load = Load(frame(spark, random_records(50)), workspace)
    rows = load._key_rows(list(RECORD_TABLES))
    for part in rows:
        text = plan(first_places(part))
        assert "SortAggregate" not in text and text.count("Exchange hashpartitioning") == 1
        assert "partial_min" in text


def test_bridges_need_no_shuffle(spark, workspace):
    load = Load(frame(spark, random_records(50)).coalesce(1), workspace)
    assert "Exchange hashpartitioning" not in plan(load.items())


def test_one_large_list_does_not_slow_the_others(spark):
    """Room for all dictionaries but one: only that one's column is shuffled."""
    records = [{**r, "keywords": f"a{i}, b{i}"} for i, r in enumerate(random_records(80))]
    whole = sorted(map(tuple, Load(frame(spark, records), Workspace(spark)).items().collect()))
    items = Load(frame(spark, records), Workspace(spark, max_rows=70)).items()
    text = plan(items)
    assert "Union" in text and "TakeOrderedAndProject" in text and "BroadcastHashJoin" in text
    assert sorted(map(tuple, items.collect())) == whole


def test_all_rules_hold(model):
    assert model.violations().where("violations > 0").collect() == []


def test_names(spark, model):
    assert table_name("card", "db_") == "db_card" and table_name("card_type", "db_") == "card_type"
    assert table_name("card_name_set_bridge", "db_") == "card_name_db_set_bridge"
    assert column_name("card_id", "db_") == "db_card_id" and column_name("artist_id", "db_") == "artist_id"
    assert len(TABLES) == 24 and len(REFERENCES) == 20
    model.create_views("db_")
    for name in TABLES:
        spark.table(table_name(name, "db_"))
    assert spark.table("vw_card_profile").columns[0] == "db_card_id"
    assert spark.table("card_name_db_set_bridge").columns == ["db_card_name", "db_set_id"]
    assert spark.table("original_text").count() == 0
