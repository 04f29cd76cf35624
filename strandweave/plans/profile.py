"""Reporting plans over the model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from strandweave.operators.aggregates import joined_names
from strandweave.operators.lookup import Lookup, attach
from strandweave.plans.model import Model
from strandweave.plans.schema import SUBTYPE, SUPERTYPE, TYPE, ListColumn
from strandweave.tables import Table


def profile(cards: DataFrame, costs: Table, names: Sequence[tuple[ListColumn, DataFrame, Table]],
            results: Sequence[str]) -> DataFrame:
    """Cards with their cost and, per list column, the joined item names.

    Each bridge is aggregated before it is joined, so no join multiplies rows; all of them
    and the cards are partitioned by card id.  ``costs`` needs only the rows with a text: a
    cost without one has no pips, and there may be as many of those as cards.
    """
    lookup = Lookup(costs, "mana_cost_id", "mana_cost_id", {"mana": "mana_cost_text", "total": "mana_cost_total"})
    result = attach(cards.select("card_id", "card_name", "mana_cost_id"), [lookup], "card_id")
    for (column, bridge, dim), name in zip(names, results):
        lists = joined_names(bridge, dim, column.id_name, column.key, name)
        result = result.join(lists, "card_id", "left")
    return result.select("card_id", "card_name", "mana", F.coalesce("total", F.lit(0)).alias("cmc"), *results)


PROFILE_LISTS = {"types": TYPE, "subtypes": SUBTYPE, "supertypes": SUPERTYPE}


def card_profile(model: Model) -> DataFrame:
    """One row per card: id, name, cost text and total, types, subtypes, supertypes."""
    names = [(column, model[column.bridge], model.sized(column.table)) for column in PROFILE_LISTS.values()]
    return profile(model["card"], model.cost_texts, names, list(PROFILE_LISTS))


def identity_within(cards: DataFrame, bridge: DataFrame, dim: Table, allowed: Sequence[str]) -> DataFrame:
    """Cards without any colour outside ``allowed``."""
    lookup = Lookup(dim, "color_identity_id", "color_identity_id", {"symbol": "color_identity_symbol"})
    outside = attach(bridge, [lookup], "card_id").where(~F.col("symbol").isin(list(allowed)))
    return cards.join(outside.select("card_id"), "card_id", "left_anti")
