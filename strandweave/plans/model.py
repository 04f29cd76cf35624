"""The normalised model as a set of tables, stored or planned."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strandweave.plans.schema import (
    KEY_COLUMNS,
    LIST_COLUMNS,
    REFERENCES,
    REQUIRED,
    STORED,
    TABLES,
    UNIQUE,
    UNIQUE_PAIRS,
    ListColumn,
    column_name,
    table_name,
)
from strandweave.sources.store import SegmentStore
from strandweave.tables import Table, Workspace

PROFILE_VIEW = "vw_card_profile"
IS_PARENT = 1 << len(REFERENCES)  # above the bits of all references


class Model:
    """Tables by neutral name, with the sizes a store knows of; others are measured once."""

    def __init__(self, tables: Mapping[str, DataFrame], workspace: Workspace, sizes: Mapping[str, tuple[int, int]]):
        self.tables = dict(tables)
        self.workspace = workspace
        self._sizes = {name: tuple(size) for name, size in sizes.items()}
        self._sized: dict[str, Table] = {}

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def sized(self, name: str) -> Table:
        if name not in self._sized:
            self._sized[name] = self.workspace.table(self.tables[name], self._sizes.get(name))
        return self._sized[name]

    @cached_property
    def cost_texts(self) -> Table:
        """Costs with a text; the known size of the costs counts only these."""
        costs = self["mana_cost"].where("mana_cost_text IS NOT NULL")
        return self.workspace.table(costs, self._sizes.get("mana_cost"))

    def renamed(self, prefix: str = "") -> dict[str, DataFrame]:
        """Tables under the names of a database that uses ``prefix``."""
        return {
            table_name(name, prefix): df.toDF(*[column_name(column, prefix) for column in df.columns])
            for name, df in self.tables.items()
        }

    def create_views(self, prefix: str = "") -> None:
        """Temporary views for every table and for the profile."""
        from strandweave.plans.profile import card_profile

        for name, df in self.renamed(prefix).items():
            df.createOrReplaceTempView(name)
        profile = card_profile(self)
        profile.withColumnRenamed("card_id", column_name("card_id", prefix)).createOrReplaceTempView(PROFILE_VIEW)

    def violations(self) -> DataFrame:
        """Every integrity rule with the number of rows that break it.

        Each table is read once and gives a row per key, reference and id, and one per null it
        should not hold; one shuffle of these, reduced in the tasks, settles all rules.  Rules are
        numbers till the faults are counted, so a row that breaks none costs two comparisons.
        """
        marks = reduce(DataFrame.unionByName, [
            rows for rows in (_marks(name, df) for name, df in self.tables.items()) if rows is not None])
        settled = marks.groupBy("space", "id", "other", "text").agg(F.count(F.lit(1)).alias("n"), F.bit_or("users").alias("users"))
        names = _rules()
        nulls, references = sum(map(len, REQUIRED.values())), len(names) - len(REFERENCES)
        is_null, is_reference = F.col("space") < nulls, F.col("space") >= references
        is_broken = is_null | F.when(is_reference, F.col("users") < IS_PARENT).otherwise(F.col("n") > 1)
        faults = settled.where(is_broken).groupBy("space", "users").agg(F.sum(F.when(is_null, F.col("n")).otherwise(F.lit(1).cast("long"))).alias("rows"))
        # From here on there is a row per rule or set of references at most.
        used = F.filter(F.sequence(F.lit(0), F.lit(len(REFERENCES) - 1)), lambda place: F.getbit("users", place) == 1)
        broken = F.when(is_reference, F.transform(used, lambda place: place + references)).otherwise(F.array("space"))
        counted = faults.select(F.explode(broken).alias("number"), "rows").groupBy("number").agg(F.sum("rows").alias("violations"))
        rules = marks.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(name) for name in names])).alias("number", "rule"))
        return rules.join(F.broadcast(counted), "number", "left").select("rule", F.coalesce("violations", F.lit(0).cast("long")).alias("violations"))


def _rules() -> list[str]:
    return [
        *[f"not null {table}.{column}" for table, columns in REQUIRED.items() for column in columns],
        *[f"unique {table}.{column}" for table, column in UNIQUE.items()],
        *[f"unique {table}" for table in UNIQUE_PAIRS],
        *[f"reference {child}.{column}" for child, column, _ in REFERENCES],
    ]


def _marks(table: str, df: DataFrame) -> DataFrame | None:
    """(space, id, other, text, users) of one table, in one pass; null where nothing is to be said.

    The space is a rule's number, or stands for a parent table behind all rules: its ids meet the
    references to it, whose places are the bits of ``users``.
    """
    number = {rule: place for place, rule in enumerate(_rules())}
    parents = {parent: len(number) + place for place, parent in enumerate(dict.fromkeys(parent for _, _, parent in REFERENCES))}
    types = dict(df.dtypes)

    def mark(space: int, columns: Sequence[str] = (), users: int = 0) -> Column:
        ids = [F.col(column) for column in columns if types[column] != "string"]
        texts = [F.col(column) for column in columns if types[column] == "string"]
        keys = zip(("id", "other", "text"), ("long", "long", "string"), (ids + 2 * [F.lit(None)])[:2] + (texts + [F.lit(None)])[:1], strict=True)
        return F.struct(F.lit(space).alias("space"), *[key.cast(kind).alias(name) for name, kind, key in keys], F.lit(users).cast("long").alias("users"))

    marks = [F.when(F.col(column).isNull(), mark(number[f"not null {table}.{column}"])) for column in REQUIRED.get(table, ())]
    if table in UNIQUE:
        column = UNIQUE[table]
        marks.append(F.when(F.col(column).isNotNull(), mark(number[f"unique {table}.{column}"], [column])))
    if table in UNIQUE_PAIRS:
        first, second = UNIQUE_PAIRS[table]
        marks.append(F.when(F.col(first).isNotNull() & F.col(second).isNotNull(), mark(number[f"unique {table}"], [first, second])))
    for place, (child, column, parent) in enumerate(REFERENCES):
        if child == table:
            marks.append(F.when(F.col(column).isNotNull(), mark(parents[parent], [column], 1 << place)))
    if table in parents:
        own = next(column for _, column, parent in REFERENCES if parent == table)
        marks.append(mark(parents[table], [own], IS_PARENT))
    if not marks:
        return None
    return df.select(F.explode(F.array(*marks)).alias("m")).where("m IS NOT NULL").select("m.*")


def bridge_of(items: DataFrame, column: ListColumn) -> DataFrame:
    """One list column's bridge from the bridges' stored form."""
    return items.where(F.col("table") == column.table).select("card_id", F.col("item_id").alias(column.id_name))


def logical_tables(stored: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The model's tables from their stored form."""
    tables = {name: df for name, df in stored.items() if name in TABLES}
    for column in (*KEY_COLUMNS.values(), *LIST_COLUMNS.values()):
        keys = stored["keys"].where(F.col("table") == column.table)
        tables[column.table] = keys.select(F.col("id").alias(column.id_name), F.col("key").alias(column.key))
    for column in LIST_COLUMNS.values():
        tables[column.bridge] = bridge_of(stored["items"], column)
    # Nothing fills this table; it exists so that queries naming it run.
    tables["original_text"] = stored["card"].sparkSession.createDataFrame([], TABLES["original_text"])
    return {name: tables[name] for name in TABLES}


def open_model(spark: SparkSession, store: SegmentStore, workspace: Workspace | None = None) -> Model:
    """The published model."""
    manifest = store.manifest()
    if manifest is None:
        raise ValueError(f"nothing has been published in {store.root}")
    stored = {name: store.read(manifest, name, schema) for name, schema in STORED.items()}
    return Model(logical_tables(stored), workspace or Workspace(spark), manifest["sizes"])
