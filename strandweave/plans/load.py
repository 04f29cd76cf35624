"""The load: staging rows into dimensions, bridges and facts.

Single-valued columns feed their dimension from every record, repeated or not; delimited
columns only from the first record of a key.  A load on top of stored tables adds rows,
and stored keys keep their ids.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import cached_property, partial, reduce
from threading import RLock

from pyspark.sql import Column, DataFrame, functions as F

from strandweave.fixed import ROW_ORD
from strandweave.functions import first_seen_id, stat_value
from strandweave.functions.ordinals import POSITION_BITS, bits_for, ordinal_limit
from strandweave.functions.text import cost_problem, stat_problem
from strandweave.operators import costs, dimensions, multivalue
from strandweave.operators.first_wins import Selection, check_ordinals, select_first
from strandweave.operators.key_index import BUCKETS, CARD_SPACE, INDEX, INDEX_PARTITION, INDEX_SCHEMA, NAME_SET_SPACE, KeyIndex, index_rows, pair_key
from strandweave.operators.lookup import Lookup, attach, not_stored
from strandweave.operators.ordinals import assign_ordinals
from strandweave.plans.model import bridge_of
from strandweave.plans.schema import (
    KEY_COLUMNS,
    KEY_TABLES,
    LIST_COLUMNS,
    SET,
    STAT_COLUMNS,
    STORED,
    STORED_PARTITION,
    ListColumn,
)
from strandweave.sources.store import SegmentStore
from strandweave.tables import Table, Workspace, run_together

# Dimensions whose keys come straight from the records; pips come from new cost texts.
RECORD_TABLES = ("mana_cost", *STAT_COLUMNS, *KEY_TABLES)
_NUMBER_BYTES = 16  # beside the key, a dimension row has two short columns


class Load:
    """One batch of staging rows. Parts are planned when asked for; shared ones are saved once."""

    def __init__(self, records: DataFrame, workspace: Workspace, existing: Mapping[str, DataFrame] | None = None,
                 numeric_power_star: bool = False, position_bits: int = POSITION_BITS, checked: bool = False,
                 index: KeyIndex | None = None):
        self.records = records
        self.index = index
        self.position_bits = position_bits
        self.checked = checked
        self.workspace = workspace
        self.existing = existing
        self.numeric_power_star = numeric_power_star
        self._dictionaries: dict[str, Table] = {}
        self._new_sizes: dict[str, tuple[int, int]] = {}
        self._lock = RLock()

    # -- first record per key -------------------------------------------------------

    @cached_property
    def selection(self) -> Selection:
        stored = None
        if self.index is not None:
            stored = self._stored_cards
        elif self.existing is not None:
            stored = self.existing["card"].select(F.col("card_uuid").alias("uuid"))
        return select_first(self.records, "uuid", self.workspace, stored, self.checked)

    def _stored_cards(self, uuids: DataFrame) -> DataFrame:
        wanted = uuids.select(F.lit(CARD_SPACE).alias("space"), F.col("uuid").alias("key"))
        return self.index.near(wanted).where(F.col("space") == CARD_SPACE).select(F.col("key").alias("uuid"))

    @cached_property
    def kept(self) -> DataFrame:
        """Records that become cards. Written once if selecting them takes a shuffle; long
        texts stay behind, they are read from staging."""
        kept = self.selection.kept()
        if self.selection.loser_count and self.selection.losers is None:
            return self.workspace.write(kept.drop("text"), "kept")
        return kept

    def status(self) -> DataFrame:
        """Per record: the id of its card, or -1 for a repeat."""
        return self.selection.status()

    # -- dictionaries: this batch's keys with their ids, and which of them are new --------

    def dictionary(self, table: str) -> Table:
        """(table, key, id, flags, is_new) of one dimension."""
        self.prepare([table])
        return self._dictionaries[table]

    def dictionaries(self, tables: Iterable[str]) -> Table:
        """Several dimensions as one table."""
        tables = list(tables)
        self.prepare(tables)
        parts = [self._dictionaries[table] for table in tables]
        size = (sum(part.size[0] for part in parts), sum(part.size[1] for part in parts))
        return self.workspace.table(reduce(DataFrame.unionByName, (part.df for part in parts)), size)

    def prepare(self, tables: Iterable[str] = RECORD_TABLES) -> None:
        """Build the dictionaries of ``tables`` that are not there yet, in one pass."""
        tables = list(tables)
        if all(table in self._dictionaries for table in tables):
            return
        with self._lock:
            wanted = [table for table in tables if table not in self._dictionaries]
            if "mana_pip" in wanted:
                self._save_dictionaries(costs.pip_keys(self.new_pip_rows), ["mana_pip"])
                wanted.remove("mana_pip")
            if wanted:
                self._save_dictionaries(reduce(DataFrame.unionByName, self._key_rows(wanted)), wanted)

    def _key_rows(self, tables: list[str]) -> list[DataFrame]:
        single = {table: self._key_and_place(table) for table in tables if table not in LIST_COLUMNS}
        lists = {table: LIST_COLUMNS[table].column for table in tables if table in LIST_COLUMNS}
        rows = []
        if single:
            rows.append(dimensions.column_keys(self.records, single))
        if lists:
            rows.append(dimensions.list_keys(self.kept, lists, bits=self.position_bits))
        if SET.table in single:
            # Items of a kept record's set column come after its whole value.
            rows.append(dimensions.list_keys(self.kept, {SET.table: SET.column}, 1, self.position_bits))
        return rows

    def _key_and_place(self, table: str) -> tuple[Column, Column]:
        if table in STAT_COLUMNS:
            star = self.numeric_power_star and table == "card_power"
            return dimensions.stat_key(STAT_COLUMNS[table], star)
        if table == "mana_cost":
            return F.upper("manaCost"), F.col(ROW_ORD)
        place = first_seen_id(F.col(ROW_ORD), 0, self.position_bits) if table == SET.table else F.col(ROW_ORD)
        return KEY_COLUMNS[table].value(), place

    def _save_dictionaries(self, key_rows: DataFrame, tables: list[str]) -> None:
        is_stat = F.col("table").isin(list(STAT_COLUMNS))
        found = dimensions.first_places(key_rows).select(
            "table",
            "key",
            F.when(is_stat, F.shiftright("place", dimensions.FLAG_BITS)).otherwise(F.col("place")).alias("id"),
            F.when(is_stat, F.col("place").bitwiseAND(F.lit((1 << dimensions.FLAG_BITS) - 1))).alias("flags"),
        )
        stored = None
        if self.existing is None:
            found_table = self.workspace.table(found)
        else:
            found_table = self.workspace.save(found, "found")
            stored = self._stored_keys(found_table.df, tables)
        resolved = self.workspace.write(dimensions.resolve(found_table, stored), "dictionary", ["table"])

        size = F.octet_length("key") + _NUMBER_BYTES
        measured = resolved.groupBy("table").agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(size).alias("bytes"),
            F.count_if("is_new").alias("new_rows"),
            F.sum(F.when(F.col("is_new"), size).otherwise(0)).alias("new_bytes"),
        )
        sizes = {row.table: row for row in measured.collect()}  # one row per dimension
        for table in tables:
            row = sizes.get(table)
            rows = resolved.where(F.col("table") == table)
            self._new_sizes[table] = (row.new_rows, row.new_bytes) if row else (0, 0)
            self._dictionaries[table] = self.workspace.table(rows, (row.rows, row.bytes) if row else (0, 0))

    def _stored_keys(self, found: DataFrame, tables: list[str]) -> DataFrame:
        """(table, key, id) that can equal a key of ``found``; all of them without an index."""
        if self.index is None:
            return stored_keys(self.existing, tables)
        near = self.index.near(found.select(F.col("table").alias("space"), "key"))
        return near.where(F.col("space").isin(tables)).withColumnRenamed("space", "table")

    @property
    def new_pip_rows(self) -> DataFrame:
        """Pips of cost texts seen for the first time; known texts are not parsed again."""
        return costs.pip_rows(self.new_keys("mana_cost"), self.position_bits)

    def new_keys(self, table: str) -> DataFrame:
        return self.dictionary(table).df.where("is_new")

    # -- tables: rows this batch adds ---------------------------------------------------------

    def dimension(self, table: str) -> DataFrame:
        keys = self.new_keys(table)
        if table == "mana_cost":
            return costs.cost_dimension(keys, self.records, "manaCost")
        if table == "mana_pip":
            return costs.pip_dimension(keys)
        if table in STAT_COLUMNS:
            return dimensions.stat_rows(keys, table)
        column = {**KEY_COLUMNS, **LIST_COLUMNS}[table]
        return keys.select(F.col("id").alias(column.id_name), F.col("key").alias(column.key))

    def plain_keys(self) -> DataFrame:
        """New keys of all plain dimensions, in stored form."""
        return self.dictionaries(KEY_TABLES).df.where("is_new").select("id", "key", "table")

    def texts(self) -> DataFrame:
        return dimensions.text_rows(self.records, "text", "oracle_text_id", "oracle_text")

    def cost_pips(self) -> DataFrame:
        return costs.cost_pip_bridge(self.new_pip_rows, self.dictionary("mana_pip"))

    def items(self, tables: Iterable[str] = tuple(LIST_COLUMNS)) -> DataFrame:
        """Bridges of delimited columns, in stored form. Lists whose dictionaries fit one
        broadcast together share a pass; the others share a second one, which shuffles."""
        tables = list(tables)
        self.prepare(tables)
        small: list[str] = []
        for table in sorted(tables, key=lambda table: self._dictionaries[table].size):
            if self.dictionaries([*small, table]).fits_broadcast():
                small.append(table)
        groups = [group for group in (small, [table for table in tables if table not in small]) if group]
        parts = []
        for group in groups:
            columns = {table: LIST_COLUMNS[table].column for table in group}
            parts.append(multivalue.item_bridge(self.kept, columns, self.dictionaries(group)))
        return reduce(DataFrame.unionByName, parts)

    def bridge(self, column: ListColumn) -> DataFrame:
        return bridge_of(self.items([column.table]), column)

    @cached_property
    def new_name_sets(self) -> DataFrame:
        """Pairs of a card name and a set that are not stored yet; saved, as two tables take them."""
        pairs = self.workspace.save(multivalue.name_set_bridge(self.kept, "name", SET.column, self.dictionary(SET.table)), "name-sets")
        if self.existing is None:
            return pairs.df
        if self.index is None:
            return not_stored(pairs, self.existing["card_name_set_bridge"], ["card_name", "set_id"])
        keyed = pairs.with_df(pairs.df.withColumn("key", pair_key("card_name", "set_id")))
        near = self.index.near(keyed.df.select(F.lit(NAME_SET_SPACE).alias("space"), "key"))
        return not_stored(keyed, near.where(F.col("space") == NAME_SET_SPACE), ["key"]).drop("key")

    def name_sets(self) -> DataFrame:
        with self._lock:
            return self.new_name_sets

    def index_keys(self) -> DataFrame:
        """(space, key, id) of every key this batch adds."""
        dimensions_new = self.dictionaries((*RECORD_TABLES, "mana_pip")).df.where("is_new AND key IS NOT NULL")
        cards = self.kept.select(F.lit(CARD_SPACE).alias("space"), F.col("uuid").alias("key"), F.col(ROW_ORD).alias("id"))
        pairs = self.name_sets().select(F.lit(NAME_SET_SPACE).alias("space"), pair_key("card_name", "set_id").alias("key"), F.col("set_id").alias("id"))
        return dimensions_new.select(F.col("table").alias("space"), "key", "id").unionByName(cards).unionByName(pairs)

    def card_costs(self) -> DataFrame:
        """Cards with only the columns the profile reads: id, name, cost id."""
        keyed = self.kept.select(
            F.col(ROW_ORD).alias("card_id"), F.col("name").alias("card_name"), F.upper("manaCost").alias("mana_cost_key")
        )
        joined = attach(keyed, [self._lookup("mana_cost")], "card_id")
        return joined.select("card_id", "card_name", _cost_id())

    def _lookup(self, table: str) -> Lookup:
        id_name = KEY_COLUMNS[table].id_name if table in KEY_COLUMNS else f"{table}_id"
        return Lookup(self.dictionary(table), f"{table}_key", "key", {id_name: "id"})

    def cards(self) -> DataFrame:
        keyed = self.kept.select(
            F.col(ROW_ORD).alias("card_id"),
            F.col("uuid").alias("card_uuid"),
            F.col("name").alias("card_name"),
            F.upper("manaCost").alias("mana_cost_key"),
            *[stat_value(F.col(name)).cast("string").alias(f"{table}_key") for table, name in STAT_COLUMNS.items()],
            *[column.value().alias(f"{table}_key") for table, column in KEY_COLUMNS.items()],
        )
        tables = ["mana_cost", *STAT_COLUMNS, *KEY_COLUMNS]
        self.prepare(tables)
        joined = attach(keyed, [self._lookup(table) for table in tables], "card_id")
        return joined.select(
            "card_id",
            "card_uuid",
            "card_name",
            _cost_id(),
            F.col("card_id").alias("oracle_text_id"),
            "card_power_id",
            "card_toughness_id",
            "artist_id",
            "set_id",
            "rarity_id",
            F.lit(None).cast("int").alias("loyalty"),
            F.lit(None).cast("boolean").alias("is_reprint"),
        )

    def stored(self) -> dict[str, Callable[[], DataFrame]]:
        """For every stored table, a callable that plans the rows to add."""
        self.prepare()
        return {
            "keys": self.plain_keys,
            "items": self.items,
            "mana_pip": partial(self.dimension, "mana_pip"),
            "mana_cost": partial(self.dimension, "mana_cost"),
            "mana_cost_mana_pip": self.cost_pips,
            "oracle_text": self.texts,
            "card_power": partial(self.dimension, "card_power"),
            "card_toughness": partial(self.dimension, "card_toughness"),
            "card": self.cards,
            "card_name_set_bridge": self.name_sets,
        }

    def new_sizes(self) -> dict[str, tuple[int, int]]:
        """(rows, bytes) this batch adds to each dimension; for costs, those with a text."""
        return dict(self._new_sizes)


def _cost_id() -> Column:
    """A card without a cost refers to its own record's cost row."""
    missing = F.col("mana_cost_key").isNull()
    return F.when(missing, F.col("card_id")).otherwise(F.col("mana_cost_id")).alias("mana_cost_id")


def stored_keys(existing: Mapping[str, DataFrame], tables: Iterable[str]) -> DataFrame:
    """Stored keys of the dimensions as (table, key, id)."""
    plain = [table for table in tables if table in KEY_TABLES]
    parts = []
    if plain:
        parts.append(existing["keys"].where(F.col("table").isin(plain)).select("table", "key", "id"))
    for table, key in (
        ("mana_cost", "mana_cost_text"),
        ("mana_pip", "mana_pip_symbol"),
        ("card_power", "card_power_value"),
        ("card_toughness", "card_toughness_value"),
    ):
        if table in tables:
            rows = existing[table].select(
                F.lit(table).alias("table"), F.col(key).cast("string").alias("key"), F.col(f"{table}_id").alias("id")
            )
            parts.append(rows.where("key IS NOT NULL"))
    return reduce(DataFrame.unionByName, parts)


REQUIRED_INPUT = ("uuid", "setCode", "rarity")
REJECTED = "rejected"


def rejection() -> Column:
    """Why a record cannot be loaded; null if it can."""
    reason = F
    for column in REQUIRED_INPUT:
        reason = reason.when(F.col(column).isNull(), f"no {column}")
    for column in STAT_COLUMNS.values():
        reason = reason.when(stat_problem(F.col(column)), f"{column} out of range")
    return reason.when(cost_problem(F.col("manaCost")), "manaCost out of range")


def _longest() -> Column:
    """Upper bound of the items in any cell of a record: its separators and braces, and one more."""
    cells = [column.column for column in LIST_COLUMNS.values()] + [SET.column]
    sizes = [F.char_length(c) - F.char_length(F.replace(F.col(c), F.lit(","), F.lit(""))) for c in cells]
    pips = F.char_length("manaCost") - F.char_length(F.replace(F.col("manaCost"), F.lit("{"), F.lit("")))
    return F.greatest(*[F.coalesce(size, F.lit(0)) for size in (*sizes, pips)]) + 2


def rejected_records(store: SegmentStore) -> DataFrame:
    """Diverted records of all published batches with the reason; empty columns if there are none."""
    manifest = store.manifest()
    names = [segment for segment in (manifest or {}).get("segments", []) if store.has(segment, REJECTED)]
    if not names:
        return store.spark.createDataFrame([], f"{ROW_ORD} bigint, uuid string, reason string")
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), [store.read_segment(name, REJECTED) for name in names])


def stored_index(store: SegmentStore, manifest: dict) -> KeyIndex | None:
    """The access path to a model's keys; none if it was published before there was one."""
    buckets = manifest.get("key_buckets")
    return KeyIndex(store.read(manifest, INDEX, INDEX_SCHEMA), buckets) if buckets else None


def compact_model(store: SegmentStore) -> None:
    """Merge the segments of all published batches into one; ids and contents stay."""
    tables = {name: (schema, STORED_PARTITION.get(name, ())) for name, schema in STORED.items()}
    if (store.manifest() or {}).get("key_buckets"):
        tables[INDEX] = (INDEX_SCHEMA, INDEX_PARTITION)
    rejected = rejected_records(store)
    if "setCode" in rejected.columns:
        tables[REJECTED] = (rejected.schema, ())
        for segment in store.manifest()["segments"]:
            if not store.has(segment, REJECTED):
                store.write(segment, REJECTED, rejected.where("false"))
    store.compact(tables)


def load_batch(store: SegmentStore, records: DataFrame, workspace: Workspace, replace: bool = False,
               batch: str | None = None, numeric_power_star: bool = False, divert: bool = False,
               order_by: Sequence[Column | str] = (), checked: bool = False, key_buckets: int = BUCKETS) -> bool:
    """Load ``records`` into ``store`` and publish, all or nothing.

    ``replace`` starts the model anew.  ``batch`` names the batch: one already published is
    skipped (returns False), so a repeated delivery changes nothing.  Records without ordinals
    get them in the order of ``order_by``.  Given ordinals must be one per record, which is
    tested unless ``checked`` says so; those that do not continue the stored ones are moved
    behind them, in their own order.  A record without key, set or rarity, or with a number
    out of range, fails the load; with ``divert`` it goes to ``rejected_records``.  A new model's
    keys are laid out in ``key_buckets`` buckets, and later batches read only those they touch
    (0: no such layout, and every batch scans all stored keys).
    """
    manifest = store.manifest()
    if manifest and batch is not None and batch in manifest["batches"]:
        return False
    existing = None
    if manifest and not replace:
        existing = {name: store.read(manifest, name, schema) for name, schema in STORED.items()}

    if ROW_ORD not in records.columns:
        if not order_by:
            raise ValueError(f"records have no {ROW_ORD}; give order_by, the order in which the first of a key wins")
        records, checked = assign_ordinals(records, order_by, workspace, ROW_ORD), True
    reason = rejection()
    low, high, placed, total, bad, example, longest = records.agg(
        F.min(ROW_ORD), F.max(ROW_ORD), F.count(ROW_ORD), F.count(F.lit(1)), F.count(reason), F.min(reason), F.max(_longest())).head()
    if placed < total:
        raise ValueError(f"{total - placed} records have no {ROW_ORD}; nothing was loaded")
    if bad and not divert:
        raise ValueError(f"{bad} records cannot be loaded ({example}); nothing was loaded")
    if not checked:
        check_ordinals(records)
    bits = bits_for(longest or 0, manifest.get("position_bits", POSITION_BITS) if existing else POSITION_BITS)
    next_ord = manifest["next_ord"] if existing else 0
    if low is not None:
        if low < next_ord or high >= ordinal_limit(bits):
            records = records.withColumn(ROW_ORD, F.col(ROW_ORD) - F.lit(low) + F.lit(next_ord))
            high += next_ord - low
        if high >= ordinal_limit(bits):  # sparse ordinals: close the gaps
            dense = assign_ordinals(records.withColumnRenamed(ROW_ORD, "given_ord"), ["given_ord"], workspace, ROW_ORD)
            records = dense.drop("given_ord").withColumn(ROW_ORD, F.col(ROW_ORD) + F.lit(next_ord))
            high = next_ord + total - 1
        next_ord = high + 1

    segment = store.new_segment()
    if bad:
        store.write(segment, REJECTED, records.withColumn("reason", reason).where("reason IS NOT NULL"))
        records = records.where(reason.isNull())
    buckets = manifest.get("key_buckets", 0) if existing else key_buckets
    index = stored_index(store, manifest) if existing else None
    load = Load(records, workspace, existing, numeric_power_star, bits, checked=True, index=index)
    plans = load.stored()

    def write(table: str) -> None:
        store.write(segment, table, plans[table](), STORED_PARTITION.get(table, ()))

    writes = {table: partial(write, table) for table in STORED}
    if buckets:
        writes[INDEX] = lambda: store.write(segment, INDEX, index_rows(load.index_keys(), buckets), INDEX_PARTITION)
    run_together(store.spark, writes)
    store.publish(segment, manifest, replace, next_ord, batch, load.new_sizes(), {"position_bits": bits, "key_buckets": buckets})
    return True
