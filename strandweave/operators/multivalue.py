"""Delimited columns into set-valued bridges."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from strandweave.fixed import ROW_ORD
from strandweave.functions import list_tokens
from strandweave.operators.dimensions import list_rows
from strandweave.operators.lookup import Lookup, attach
from strandweave.tables import Table


def item_key(table: Column, key: Column) -> Column:
    """One text for (table, key); table names contain no colon, so no two pairs share it."""
    return F.concat(table, F.lit(":"), key)


def item_bridge(kept: DataFrame, columns: Mapping[str, str], keys: Table) -> DataFrame:
    """Distinct (table, card_id, item_id) of several delimited columns, in one pass.

    A record's ordinal is unique, so equal pairs can only come from one cell and are dropped
    inside the row; nothing is shuffled for it.  ``keys`` holds (table, key, id).
    """
    rows = list_rows(kept, columns, distinct=True)
    pairs = rows.select("table", F.col(ROW_ORD).alias("card_id"), item_key(F.col("table"), F.col("key")).alias("item"))
    dim = keys.with_df(keys.df.select(item_key(F.col("table"), F.col("key")).alias("item"), "id"))
    return attach(pairs, [Lookup(dim, "item", "item", {"item_id": "id"})], "card_id").select("table", "card_id", "item_id")


def name_set_bridge(kept: DataFrame, name: str, sets: str, keys: Table) -> DataFrame:
    """Distinct (record name, set id) pairs; names repeat across records, so this one shuffles."""
    pairs = kept.where(F.col(name).isNotNull()).select(
        F.col(name).alias("card_name"), F.explode(F.array_distinct(list_tokens(F.col(sets)))).alias("set_key")
    )
    joined = attach(pairs.distinct(), [Lookup(keys, "set_key", "key", {"set_id": "id"})], "card_name")
    return joined.select("card_name", "set_id")
