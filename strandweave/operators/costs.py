"""Cost texts, their pips and their totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strandweave.fixed import ROW_ORD
from strandweave.functions import brace_tokens, first_seen_id, integer, pip_cost, pip_symbol, total_cost
from strandweave.functions.ordinals import POSITION_BITS
from strandweave.operators.lookup import Lookup, attach
from strandweave.tables import Table


def null_costs(records: DataFrame, column: str) -> DataFrame:
    """A cost row for every record without a cost: nulls never equal one another."""
    return records.where(F.col(column).isNull()).select(
        F.col(ROW_ORD).alias("mana_cost_id"),
        F.lit(None).cast("string").alias("mana_cost_text"),
        F.lit(0).alias("mana_cost_total"),
    )


def cost_rows(keys: DataFrame) -> DataFrame:
    """Cost rows of distinct texts. Totals are summed inside each text's row."""
    return keys.select(
        F.col("id").alias("mana_cost_id"),
        F.col("key").alias("mana_cost_text"),
        total_cost(F.col("key")).alias("mana_cost_total"),
    )


def cost_dimension(keys: DataFrame, records: DataFrame, column: str) -> DataFrame:
    return cost_rows(keys).unionByName(null_costs(records, column))


def pip_rows(keys: DataFrame, bits: int = POSITION_BITS) -> DataFrame:
    """Every pip of every distinct cost text, repeats kept."""
    tokens = keys.select(F.col("id").alias("mana_cost_id"), F.posexplode(brace_tokens(F.col("key"))).alias("pos", "token"))
    return tokens.select(
        first_seen_id(F.col("mana_cost_id"), F.col("pos"), bits).alias("mana_cost_mana_pip_id"),
        "mana_cost_id",
        pip_symbol(F.col("token")).alias("mana_pip_symbol"),
    )


def pip_keys(pips: DataFrame) -> DataFrame:
    """Key rows of the pips, see ``dimensions``."""
    return pips.select(
        F.lit("mana_pip").alias("table"), F.col("mana_pip_symbol").alias("key"), F.col("mana_cost_mana_pip_id").alias("place")
    )


def pip_dimension(keys: DataFrame) -> DataFrame:
    return keys.select(
        F.col("id").alias("mana_pip_id"),
        F.col("key").alias("mana_pip_symbol"),
        pip_cost(F.col("key")).alias("mana_pip_cost"),
    )


def cost_pip_bridge(pips: DataFrame, keys: Table) -> DataFrame:
    """Bag of (cost, pip): one row per printed pip."""
    joined = attach(pips, [Lookup(keys, "mana_pip_symbol", "key", {"mana_pip_id": "id"})], "mana_cost_mana_pip_id")
    return joined.select("mana_cost_mana_pip_id", "mana_cost_id", "mana_pip_id")


def cost_totals(costs: DataFrame, bridge: DataFrame, pips: Table) -> DataFrame:
    """Totals recomputed from the stored bridge: sum per cost, 0 for a cost without pips."""
    lookup = Lookup(pips, "mana_pip_id", "mana_pip_id", {"mana_pip_cost": "mana_pip_cost"})
    priced = attach(bridge.select("mana_cost_mana_pip_id", "mana_cost_id", "mana_pip_id"), [lookup], "mana_cost_mana_pip_id")
    totals = priced.groupBy("mana_cost_id").agg(F.sum("mana_pip_cost").alias("total"))
    return costs.select("mana_cost_id", "mana_cost_text").join(totals, "mana_cost_id", "left").select(
        "mana_cost_id",
        "mana_cost_text",
        integer(F.coalesce("total", F.lit(0).cast("long")).cast("string")).alias("mana_cost_total"),
    )
