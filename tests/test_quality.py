from records import frame, record

from strandweave import SegmentStore, load_batch, open_model
from strandweave.operators import quality
from strandweave.plans.model import Model


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_rules(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, None), (4, "b")], "id long, k string")
    assert rows(quality.repeated_keys(df, ["k"])) == [("a", 2)]  # nulls never repeat
    assert rows(quality.repeated_keys(df, ["id", "k"])) == [(1, "a", 2)]
    assert [row.id for row in quality.missing_values(df, "k").orderBy("id").collect()] == [2, 3]
    assert rows(quality.missing_counts(df, ["id", "k"], "t.")) == [("not null t.id", 0), ("not null t.k", 2)]
    parent = spark.createDataFrame([("a",)], "key string")
    assert rows(quality.dangling_references(df, "k", parent, "key")) == [("b", 1)]
    assert rows(quality.violations("rule", quality.missing_values(df, "k"))) == [("rule", 2)]


def test_review_and_orphans(spark):
    records = frame(spark, [record(str(i), power=p) for i, p in enumerate(["X", "1+*", None, "", "2"])])
    assert rows(quality.for_review(records, "power")) == [(1, "1+*"), (3, "")]
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "id long, k string")
    fact = spark.createDataFrame([(1,), (1,), (None,)], "fk long")
    assert rows(quality.orphans(dim, "id", fact, "fk")) == [(2, "b")]


def test_rules_of_a_broken_model(spark, workspace):
    """Each table is scanned once, rows meet in one shuffle, and every kind of fault is counted."""
    store = SegmentStore(spark, workspace.folder("store"))
    load_batch(store, frame(spark, [record("a", manaCost="{1}{G}", types="T,U"), record("b", types="T", keywords="k")]), workspace)
    model = open_model(spark, store, workspace)
    sound = {row.rule: row.violations for row in model.violations().collect()}
    assert len(sound) > 60 and set(sound.values()) == {0}

    def more(table, *rows):
        return model[table].unionByName(spark.createDataFrame(rows, model[table].schema))

    tables = dict(model.tables)
    tables["artist"] = more("artist", (90, "UNKNOWN"), (91, None), (92, None))
    tables["card_type_bridge"] = more("card_type_bridge", (0, 77), (0, 77), (55, 77), (1, None))
    tables["rarity"] = model["rarity"].where("false")
    broken = Model(tables, workspace, {}).violations()
    assert {row.rule: row.violations for row in broken.collect() if row.violations} == {
        "unique artist.artist_name": 1, "not null artist.artist_name": 2, "unique card_type_bridge": 1, "not null card_type_bridge.card_type_id": 1,
        "reference card_type_bridge.card_type_id": 1, "reference card_type_bridge.card_id": 1, "reference card.rarity_id": 1,
    }
    plan = model.violations()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 25 and plan.count("Exchange hashpartitioning") <= 3


def test_faults_are_counted_before_rules_are_named(spark, workspace):
    """Rows of the large aggregate meet a filter and a count only; ids missing for several references count for each."""
    store = SegmentStore(spark, workspace.folder("store"))
    load_batch(store, frame(spark, [record("a", manaCost="{1}{G}", types="T,U"), record("b", types="T", keywords="k")]), workspace)
    model = open_model(spark, store, workspace)
    sections = model.violations()._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning")
    assert "Generate" in sections[-1] and "Generate" not in sections[-2]

    def more(table, *rows):
        return model[table].unionByName(spark.createDataFrame(rows, model[table].schema))

    tables = dict(model.tables)
    tables["mana_cost_mana_pip"] = more("mana_cost_mana_pip", (500, 700, 900), (501, 701, 900))
    tables["card"] = more("card", *[(id, f"x{id}", "n", cost, None, None, None, None, None, None, None, None) for id, cost in ((50, 700), (51, 700), (52, 702))])
    tables["card_name_set_bridge"] = more("card_name_set_bridge", ("n", 800), ("n", 800), ("n", 801), ("m", 800), (None, 800), (None, 800))
    broken = Model(tables, workspace, {}).violations()
    assert {row.rule: row.violations for row in broken.collect() if row.violations} == {
        "not null card.oracle_text_id": 3, "not null card.artist_id": 3, "not null card.set_id": 3, "not null card.rarity_id": 3,
        "not null card_name_set_bridge.card_name": 2, "unique card_name_set_bridge": 1, "reference card_name_set_bridge.set_id": 2,
        "reference mana_cost_mana_pip.mana_cost_id": 2, "reference mana_cost_mana_pip.mana_pip_id": 1, "reference card.mana_cost_id": 2,
    }
