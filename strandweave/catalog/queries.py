"""One query per operator, over staging records derived from ``orders`` or another given table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from strandweave.fixed import ROW_ORD, STAGING_COLUMNS
from strandweave.functions import brace_tokens, list_tokens
from strandweave.functions.sql import register_sql_functions
from strandweave.operators import costs, quality
from strandweave.operators.aggregates import joined_names
from strandweave.operators.first_wins import first_rows
from strandweave.operators.ordinals import assign_ordinals
from strandweave.plans.containment import cards_with, index_lists
from strandweave.plans.load import Load, compact_model, load_batch, rejected_records
from strandweave.plans.model import PROFILE_VIEW, Model, bridge_of, open_model
from strandweave.plans import profile as profiles
from strandweave.plans.profile import PROFILE_LISTS, card_profile, profile
from strandweave.plans.schema import ABILITY, COLOR, LIST_COLUMNS, TYPE, ListColumn
from strandweave.plans.synthetic import staging_from_orders
from strandweave.sources.csv import stage_csv
from strandweave.sources.store import SegmentStore
from strandweave.streaming import changes, current_totals, first_keys, item_bridge, latest_totals, list_items, load_stream, running_totals, write_changes, write_item_bridge, write_totals
from strandweave.tables import Table, Workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_from_orders(given(spark, sf_dir, "orders"))


def load(spark: SparkSession, sf_dir: str, **options) -> Load:
    return Load(staging(spark, sf_dir), Workspace(spark), **options)


# -- sources -------------------------------------------------------------------------------


@query
def staging_projection(spark, sf_dir):
    return staging(spark, sf_dir)


# Written as they are: blanks kept, null as an empty field, empty text as a quoted one.
CSV_OUT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


@query
def csv_roundtrip(spark, sf_dir):
    """Staging written as several CSV files in record order, then staged from them."""
    workspace = Workspace(spark)
    folder = workspace.folder("csv")
    ordered = staging(spark, sf_dir).repartitionByRange(ROW_ORD).sortWithinPartitions(ROW_ORD)
    ordered.select(*STAGING_COLUMNS).write.options(**CSV_OUT).csv(folder)
    return stage_csv(spark, folder, SegmentStore(spark, workspace.folder("staging")))


# -- first record per key --------------------------------------------------------------------


@query
def first_wins_cards(spark, sf_dir):
    return first_rows(staging(spark, sf_dir), "uuid").select(ROW_ORD, "uuid", "name")


@query
def load_status(spark, sf_dir):
    return load(spark, sf_dir).status()


@query
def fact_cards(spark, sf_dir):
    return load(spark, sf_dir).cards()


@query
def text_rows(spark, sf_dir):
    return load(spark, sf_dir).texts()


# -- dimensions and bridges ----------------------------------------------------------------------


def _dimension(table: str) -> Query:
    return lambda spark, sf_dir: load(spark, sf_dir).dimension(table)


def _bridge(column: ListColumn) -> Query:
    return lambda spark, sf_dir: load(spark, sf_dir).bridge(column)


SHORT_NAMES = {
    "card_type": "type",
    "card_subtype": "subtype",
    "card_supertype": "supertype",
    "format": "format",
    "card_ability": "ability",
    "color_identity": "color",
}
for _table, _short in SHORT_NAMES.items():
    QUERIES[f"dim_{_short}"] = _dimension(_table)
    QUERIES[f"bridge_{_short}"] = _bridge(LIST_COLUMNS[_table])
for _table in ("artist", "set", "rarity"):
    QUERIES[f"dim_{_table}"] = _dimension(_table)
QUERIES["dim_power"] = _dimension("card_power")
QUERIES["dim_toughness"] = _dimension("card_toughness")
QUERIES["dim_cost"] = _dimension("mana_cost")
QUERIES["dim_pip"] = _dimension("mana_pip")


@query
def dim_power_numeric_star(spark, sf_dir):
    """Power values with plain numbers flagged as star too."""
    return load(spark, sf_dir, numeric_power_star=True).dimension("card_power")


@query
def cost_pips(spark, sf_dir):
    return load(spark, sf_dir).cost_pips()


@query
def cost_totals(spark, sf_dir):
    batch = load(spark, sf_dir)
    pips = batch.dictionary("mana_pip").with_df(batch.dimension("mana_pip"))
    return costs.cost_totals(batch.dimension("mana_cost"), batch.cost_pips(), pips)


@query
def name_set_bridge(spark, sf_dir):
    return load(spark, sf_dir).name_sets()


@query
def identity_within(spark, sf_dir):
    """Cards that fit a white and blue identity."""
    batch = load(spark, sf_dir)
    cards = batch.kept.select(F.col(ROW_ORD).alias("card_id"), "uuid")
    return profiles.identity_within(cards, batch.bridge(COLOR), _sized(batch, COLOR), ["W", "U"])


def _sized(batch: Load, column: ListColumn) -> Table:
    """A fresh load's dimension, with its known size."""
    return batch.dictionary(column.table).with_df(batch.dimension(column.table))


# -- aggregates and the profile --------------------------------------------------------------------


def _joined(result: str) -> Query:
    def run(spark, sf_dir):
        batch, column = load(spark, sf_dir), PROFILE_LISTS[result]
        return joined_names(batch.bridge(column), _sized(batch, column), column.id_name, column.key, result)

    return run


for _result in PROFILE_LISTS:
    QUERIES[f"agg_{_result}"] = _joined(_result)


def planned_profile(batch: Load) -> DataFrame:
    """The profile of one load, from only the parts it needs; all lists are split in one pass."""
    tables = [column.table for column in PROFILE_LISTS.values()]
    batch.prepare(["mana_cost", *tables])
    items = batch.workspace.write(batch.items(tables), "items", ["table"])
    names = [(column, bridge_of(items, column), _sized(batch, column)) for column in PROFILE_LISTS.values()]
    dictionary = batch.dictionary("mana_cost")
    texts = dictionary.with_df(costs.cost_rows(dictionary.df))
    return profile(batch.card_costs(), texts, names, list(PROFILE_LISTS))


QUERIES["card_profile"] = lambda spark, sf_dir: planned_profile(load(spark, sf_dir))


def loaded_model(spark: SparkSession, sf_dir: str) -> Model:
    workspace = Workspace(spark)
    store = SegmentStore(spark, workspace.folder("store"))
    load_batch(store, staging(spark, sf_dir), workspace, replace=True)
    return open_model(spark, store, workspace)


def _indexed_cards(column: ListColumn, **conditions) -> Query:
    """Cards of the published model by what a list holds, from its bitmaps."""

    def run(spark, sf_dir):
        workspace = Workspace(spark)
        store = SegmentStore(spark, workspace.folder("store"))
        load_batch(store, staging(spark, sf_dir), workspace, replace=True)
        index_lists(store)
        return cards_with(store, column, **conditions)

    return run


QUERIES["cards_with_all"] = _indexed_cards(TYPE, all_of=["Artifact", "Creature"])
QUERIES["cards_with_none"] = _indexed_cards(ABILITY, none_of=["Ability1", "Ability4"])
QUERIES["cards_with_only"] = _indexed_cards(COLOR, all_of=["W"], only=["W", "U"])


@query
def profile_by_id(spark, sf_dir):
    """One card of the published model; the filter reaches every scan."""
    return card_profile(loaded_model(spark, sf_dir)).where("card_id = 1")


@query
def profile_by_cost(spark, sf_dir):
    """The stored total as a filter."""
    return card_profile(loaded_model(spark, sf_dir)).where("cmc >= 8")


@query
def ordinals_assigned(spark, sf_dir):
    """Orders numbered by date, then key."""
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return assign_ordinals(orders, ["o_orderdate", "o_orderkey"], Workspace(spark)).select("o_orderkey", ROW_ORD)


# Records made unfit for a load: what is broken follows from the ordinal.
BROKEN = {
    "uuid": "case when row_ord % 97 = 0 then null else uuid end",
    "power": "case when row_ord % 89 = 0 then '99999999999' else power end",
    "manaCost": "case when row_ord % 83 = 0 then '{99999999999}' else manaCost end",
}


@query
def load_rejected(spark, sf_dir):
    """What a load diverts, and why."""
    workspace = Workspace(spark)
    store = SegmentStore(spark, workspace.folder("store"))
    records = staging(spark, sf_dir)
    broken = records.select(*[F.expr(BROKEN[c]).alias(c) if c in BROKEN else F.col(c) for c in records.columns])
    load_batch(store, broken, workspace, divert=True)
    return rejected_records(store).select(ROW_ORD, "reason")


@query
def profile_view(spark, sf_dir):
    """SQL over the named views of a published model."""
    loaded_model(spark, sf_dir).create_views("db_")
    return spark.sql(
        f"""
        SELECT s.db_set_name AS set_name, p.types, count(*) AS cards, sum(p.cmc) AS total_cmc
        FROM {PROFILE_VIEW} p
        JOIN db_card c ON c.db_card_id = p.db_card_id
        JOIN db_set s ON s.db_set_id = c.db_set_id
        GROUP BY s.db_set_name, p.types
        """
    )


@query
def incremental_load(spark, sf_dir):
    """Two batches, the earlier half of the records and the later half; profile of the result."""
    workspace = Workspace(spark)
    store = SegmentStore(spark, workspace.folder("store"))
    records = staging(spark, sf_dir)
    middle = records.agg((F.max(ROW_ORD) / 2).cast("long")).head()[0]
    load_batch(store, records.where(F.col(ROW_ORD) <= middle), workspace, batch="earlier")
    load_batch(store, records.where(F.col(ROW_ORD) > middle), workspace, batch="later")
    return card_profile(open_model(spark, store, workspace))


@query
def compacted_profile(spark, sf_dir):
    """Three batches, merged into one segment; profile of the result."""
    workspace = Workspace(spark)
    store = SegmentStore(spark, workspace.folder("store"))
    records = staging(spark, sf_dir)
    third = records.agg((F.max(ROW_ORD) / 3).cast("long") + 1).head()[0]
    for part in range(3):
        load_batch(store, records.where(F.floor(F.col(ROW_ORD) / third) == part), workspace, batch=str(part))
    compact_model(store)
    return card_profile(open_model(spark, store, workspace))


# -- integrity --------------------------------------------------------------------------------------------


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@query
def dq_unique(spark, sf_dir):
    batch = load(spark, sf_dir)
    return _union([
        quality.violations("staging.uuid", quality.repeated_keys(batch.records, ["uuid"])),
        quality.violations("artist.artist_name", quality.repeated_keys(batch.dimension("artist"), ["artist_name"])),
        quality.violations("mana_cost.mana_cost_text", quality.repeated_keys(batch.dimension("mana_cost"), ["mana_cost_text"])),
    ])


@query
def dq_not_null(spark, sf_dir):
    return quality.missing_counts(staging(spark, sf_dir), STAGING_COLUMNS, "staging.")


@query
def dq_fk(spark, sf_dir):
    batch = load(spark, sf_dir)
    return _union([
        quality.violations(rule, quality.dangling_references(child, column, parent, parent_column))
        for rule, child, column, parent, parent_column in (
            ("labels.doc_id", given(spark, sf_dir, "labels"), "doc_id", given(spark, sf_dir, "documents"), "doc_id"),
            ("orders.o_custkey", given(spark, sf_dir, "orders"), "o_custkey", given(spark, sf_dir, "customer"), "c_custkey"),
            ("lineitem.l_orderkey", given(spark, sf_dir, "lineitem"), "l_orderkey", given(spark, sf_dir, "orders"), "o_orderkey"),
            ("events.user_id", given(spark, sf_dir, "events"), "user_id", given(spark, sf_dir, "customer"), "c_custkey"),
            ("staging.name", batch.records, "name", batch.kept, "name"),
        )
    ])


@query
def dq_pairs(spark, sf_dir):
    return quality.repeated_keys(given(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_review(spark, sf_dir):
    records = staging(spark, sf_dir)
    return _union([
        quality.for_review(records, column).select(F.lit(column).alias("stat"), ROW_ORD, "printed")
        for column in ("power", "toughness")
    ])


@query
def dq_orphans(spark, sf_dir):
    """Texts and costs that only repeated records referred to."""
    batch = load(spark, sf_dir)
    cards = batch.card_costs().withColumn("oracle_text_id", F.col("card_id"))
    text = quality.orphans(batch.texts(), "oracle_text_id", cards, "oracle_text_id")
    cost = quality.orphans(batch.dimension("mana_cost"), "mana_cost_id", cards, "mana_cost_id")
    return _union([
        text.select(F.lit("oracle_text").alias("table_name"), F.col("oracle_text_id").alias("id")),
        cost.select(F.lit("mana_cost").alias("table_name"), F.col("mana_cost_id").alias("id")),
    ])


@query
def model_integrity(spark, sf_dir):
    """Every rule of the published model."""
    return loaded_model(spark, sf_dir).violations()


# -- streams -----------------------------------------------------------------------------------------------------


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = given(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _finish(frame: DataFrame, workspace: Workspace) -> DataFrame:
    """Run an append stream over what is there now; its output as a table."""
    path = workspace.folder("output")
    writer = frame.writeStream.option("checkpointLocation", workspace.folder("checkpoint")).option("path", path)
    writer.format("parquet").trigger(availableNow=True).start().awaitTermination()
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@query
def stream_running_total(spark, sf_dir):
    workspace = Workspace(spark)
    path = workspace.folder("totals")
    totals = running_totals(event_stream(spark, sf_dir), "event_type", F.col("value").cast("decimal(18,4)"))
    write_totals(totals, path, workspace.folder("checkpoint")).awaitTermination()
    latest = latest_totals(spark, path, "event_type")
    return latest.select("event_type", F.round(F.col("total").cast("double"), 4).alias("total"))


@query
def stream_total_updates(spark, sf_dir):
    """Users as rows that events update: each counts with its last event, under that event's type.

    The events come in three micro-batches, dealt by their numbers, so later ones meet earlier ones and overtake them.
    """
    workspace = Workspace(spark)
    incoming, path, checkpoint = (workspace.folder(name) for name in ("incoming", "totals", "checkpoint"))
    events = given(spark, sf_dir, "events")
    for part in (1, 2, 0):
        events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(incoming)
        stream = spark.readStream.schema(events.schema).parquet(incoming)
        write_changes(changes(stream, "user_id", "event_id", "event_type", F.col("value")), path, checkpoint, fold=2).awaitTermination()
    return current_totals(spark, path).select(F.col("group").alias("event_type"), F.col("total").cast("double").alias("total"), F.col("rows").alias("users"))


@query
def stream_get_or_insert(spark, sf_dir):
    return _finish(first_keys(event_stream(spark, sf_dir), "user_id"), Workspace(spark))


@query
def stream_tokens(spark, sf_dir):
    items = list_items(event_stream(spark, sf_dir).select("props"), "props")
    return _finish(first_keys(items, "item"), Workspace(spark))


@query
def stream_item_bridge(spark, sf_dir):
    """Types of the kept records in three micro-batches, as bridge rows with ids."""
    workspace = Workspace(spark)
    records = first_rows(staging(spark, sf_dir), "uuid").select(ROW_ORD, "types")
    third = records.agg((F.max(ROW_ORD) / 3).cast("long") + 1).head()[0]
    incoming, path, checkpoint = (workspace.folder(name) for name in ("incoming", "bridge", "checkpoint"))
    for part in range(3):
        records.where(F.floor(F.col(ROW_ORD) / third) == part).write.mode("append").parquet(incoming)
        stream = spark.readStream.schema(records.schema).parquet(incoming)
        write_item_bridge(stream, "types", path, checkpoint, fold=2).awaitTermination()
    return item_bridge(spark, path).select(F.col("owner").alias("card_id"), F.col("item_id").alias("card_type_id"))


@query
def stream_incremental_load(spark, sf_dir):
    """Staging written in record order as files, loaded file group by file group from a stream."""
    workspace = Workspace(spark)
    records = staging(spark, sf_dir)
    folder = workspace.folder("incoming")
    middle = records.agg((F.max(ROW_ORD) / 2).cast("long")).head()[0]
    store = SegmentStore(spark, workspace.folder("store"))
    checkpoint = workspace.folder("checkpoint")
    for half in (F.col(ROW_ORD) <= middle, F.col(ROW_ORD) > middle):
        records.where(half).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(records.schema).parquet(folder)
        load_stream(stream, store, checkpoint).awaitTermination()
    return card_profile(open_model(spark, store, workspace))


# -- tokenisers on other tables -----------------------------------------------------------------------------------


def _token_counts(frame: DataFrame, owner: str, tokens) -> DataFrame:
    """Uses of every token, and where it is first seen: owner and position.

    Both places are taken by one minimum over a number of fixed width, which any 64-bit owner fits.
    """
    rows = frame.select(owner, F.posexplode(tokens).alias("pos", "token"))
    wide = F.lit(1 << 31).cast("decimal(10,0)")
    place = (F.col(owner).cast("decimal(19,0)") * wide + F.col("pos")).cast("decimal(38,0)")
    counted = rows.groupBy("token").agg(F.count(F.lit(1)).alias("uses"), F.min(place).alias("place"))
    owner_of = F.floor(F.col("place") / wide).cast("long")
    first_pos = F.pmod("place", wide.cast("decimal(38,0)")).cast("int")
    return counted.select("token", "uses", owner_of.alias("first_owner"), first_pos.alias("first_pos"))


@query
def html_tag_pips(spark, sf_dir):
    pages = given(spark, sf_dir, "pages")
    return _token_counts(pages, "page_id", brace_tokens(F.col("html"), r"<([^>]+)>"))


@query
def doc_tokens(spark, sf_dir):
    return _token_counts(given(spark, sf_dir, "documents"), "doc_id", list_tokens(F.col("text")))


@query
def sql_functions(spark, sf_dir):
    """Key rules and tokenisers from SQL."""
    register_sql_functions(spark)
    staging(spark, sf_dir).createOrReplaceTempView("staging_records")
    return spark.sql(
        """
        SELECT rarity_key(s.rarity) AS rarity, i.item, count(*) AS uses
        FROM staging_records s, LATERAL list_items(s.types) i
        GROUP BY rarity_key(s.rarity), i.item
        """
    )


@query
def sql_cost_tokens(spark, sf_dir):
    register_sql_functions(spark)
    staging(spark, sf_dir).createOrReplaceTempView("staging_records")
    return spark.sql(
        """
        SELECT s.row_ord, t.pos, pip_symbol(t.token) AS symbol
        FROM staging_records s, LATERAL cost_tokens(s.manaCost) t
        """
    )
