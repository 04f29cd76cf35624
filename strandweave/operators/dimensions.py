"""Deduplicated keys with first-seen ids, for any number of dimensions in one pass.

Key rows have the columns ``table``, ``key`` and ``place``; the smallest place of a key
becomes its id.  All dimensions share one shuffle of distinct keys, which tasks have already
reduced, so a popular key adds no skew.  Single columns, delimited columns and the items of
set columns are read by a scan each, whatever the number of dimensions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from strandweave.fixed import ROW_ORD
from strandweave.functions import first_seen_id, list_tokens, stat_flags, stat_value
from strandweave.functions.ordinals import POSITION_BITS
from strandweave.operators.lookup import known
from strandweave.tables import Table

FLAG_BITS = 2


def column_keys(records: DataFrame, columns: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Key rows of single-valued columns: table -> (key, place). Null keys give no row."""
    rows = [
        F.struct(F.lit(table).alias("table"), key.alias("key"), place.alias("place"))
        for table, (key, place) in columns.items()
    ]
    return records.select(F.inline(F.array(*rows))).where("key IS NOT NULL")


def list_rows(records: DataFrame, columns: Mapping[str, str], distinct: bool = False) -> DataFrame:
    """(row_ord, table, pos, key) per item of delimited columns: table -> column.

    ``distinct`` keeps one of the equal items of a cell, and numbers what is left.
    """
    cells = [F.struct(F.lit(table).alias("table"), F.col(column).alias("cell")) for table, column in columns.items()]
    rows = records.select(ROW_ORD, F.inline(F.array(*cells)))
    items = list_tokens(F.col("cell"))
    if distinct:
        items = F.array_distinct(items)
    return rows.select(ROW_ORD, "table", F.posexplode(items).alias("pos", "key"))


def list_keys(records: DataFrame, columns: Mapping[str, str], offset: int = 0, bits: int = POSITION_BITS) -> DataFrame:
    """Key rows of delimited columns."""
    rows = list_rows(records, columns)
    return rows.select("table", "key", first_seen_id(F.col(ROW_ORD), F.col("pos") + offset, bits).alias("place"))


def stat_key(column: str, numeric_star: bool = False) -> tuple[Column, Column]:
    """Key and place of a printed power or toughness.

    Different texts can share a value (a literal -9999 and X); the flags are those of the
    first one, carried in the low bits of the place so that the smallest place picks both.
    """
    flags = stat_flags(F.col(column), numeric_star).cast("long")
    place = F.shiftleft(F.col(ROW_ORD), FLAG_BITS).bitwiseOR(flags)
    return stat_value(F.col(column)).cast("string"), place


def first_places(key_rows: DataFrame) -> DataFrame:
    """Distinct keys with their smallest place."""
    return key_rows.groupBy("table", "key").agg(F.min("place").alias("place"))


def resolve(found: Table, existing: DataFrame | None) -> DataFrame:
    """Existing-wins merge of a batch's keys (table, key, id): the stored id where there is
    one, plus ``is_new``."""
    if existing is None:
        return found.df.withColumn("is_new", F.lit(True))
    stored = known(existing, found, ["table", "key"]).withColumnRenamed("id", "stored_id")
    if found.fits_broadcast():
        stored = F.broadcast(stored)  # a subset of the measured keys
    joined = found.df.join(stored, ["table", "key"], "left")
    others = [name for name in found.df.columns if name != "id"]
    return joined.select(
        F.coalesce("stored_id", "id").alias("id"), *others, F.col("stored_id").isNull().alias("is_new")
    )


def stat_rows(keys: DataFrame, table: str) -> DataFrame:
    """Stored form of power or toughness keys (id, key, flags)."""
    return keys.select(
        F.col("id").alias(f"{table}_id"),
        F.col("key").cast("int").alias(f"{table}_value"),
        (F.col("flags").bitwiseAND(F.lit(2)) > 0).alias(f"is_x_{table}"),
        (F.col("flags").bitwiseAND(F.lit(1)) > 0).alias(f"is_star_{table}"),
    )


def text_rows(records: DataFrame, column: str, id_name: str, text_name: str) -> DataFrame:
    """One row per record, repeats and nulls kept; the id is the record's ordinal."""
    return records.select(F.col(ROW_ORD).alias(id_name), F.col(column).alias(text_name))
