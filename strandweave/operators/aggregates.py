"""Ordered string aggregates over a bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strandweave.operators.lookup import Lookup, attach
from strandweave.tables import Table


def joined_names(bridge: DataFrame, dim: Table, id_name: str, name: str, result: str, owner: str = "card_id") -> DataFrame:
    """Per owner, the names of its items in id order, separated by a blank."""
    named = attach(bridge, [Lookup(dim, id_name, id_name, {name: name})], owner)
    return named.groupBy(owner).agg(F.expr(f"listagg({name}, ' ') WITHIN GROUP (ORDER BY {id_name})").alias(result))
