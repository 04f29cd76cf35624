"""Keep the first record per key, and say what became of each record.

The winners are found on two narrow columns with a hash aggregate, so a key with very
many copies collapses before the shuffle.  Few losers are then sieved out by the scan
itself; many make the records meet the winners by their own ordinal, which is unique, so
no copy count can skew that join either.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from strandweave.fixed import DUPLICATE, ROW_ORD
from strandweave.operators.lookup import known
from strandweave.tables import Table, Workspace


def first_ordinals(records: DataFrame, key: str) -> DataFrame:
    """One row per key with its smallest ordinal and its number of records, ``placed`` ones among them."""
    return records.groupBy(key).agg(
        F.min(ROW_ORD).alias(ROW_ORD), F.count(F.lit(1)).alias("copies"), F.count(ROW_ORD).alias("placed"))


def check_ordinals(records: DataFrame) -> None:
    """Every record needs an ordinal of its own; anything else would leave the winner to chance."""
    repeated = records.groupBy(ROW_ORD).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    row = repeated.select(ROW_ORD).head(1)
    if row:
        raise ValueError(f"{ROW_ORD} {row[0][0]} belongs to several records; assign_ordinals gives each its own")


def first_rows(records: DataFrame, key: str) -> DataFrame:
    """The first record of every key, as one lazy plan."""
    return records.join(first_ordinals(records, key).select(ROW_ORD), ROW_ORD, "left_semi")


@dataclass
class Selection:
    """Winning ordinals and, while they are few, the losing ones."""

    records: DataFrame
    winners: DataFrame
    losers: DataFrame | None
    loser_count: int

    def kept(self) -> DataFrame:
        if self.loser_count == 0:
            return self.records
        if self.losers is not None:
            return self.records.join(F.broadcast(self.losers), ROW_ORD, "left_anti")
        return self.records.join(self.winners, ROW_ORD, "left_semi")

    def status(self, result: str = "result") -> DataFrame:
        """Per record: its id if it was kept, else -1."""
        ordinals = self.records.select(ROW_ORD)
        duplicate = F.lit(DUPLICATE).cast("long")
        if self.losers is not None:
            other = F.broadcast(self.losers.select(F.col(ROW_ORD).alias("other")))
            value = F.when(F.col("other").isNull(), F.col(ROW_ORD)).otherwise(duplicate)
        else:
            other = self.winners.select(F.col(ROW_ORD).alias("other"))
            value = F.coalesce("other", duplicate)
        joined = ordinals.join(other, F.col(ROW_ORD) == F.col("other"), "left")
        return joined.select(ROW_ORD, value.alias(result))


def select_first(records: DataFrame, key: str, workspace: Workspace,
                 existing: DataFrame | Callable[[DataFrame], DataFrame] | None = None, checked: bool = False) -> Selection:
    """Find winners: a stored key (column ``key`` of ``existing``) first, then the smallest ordinal.

    ``existing`` may be a function from the batch's keys to the stored keys that can equal them.
    Null and repeated ordinals are errors; ``checked`` says that they cannot repeat.
    """
    if not checked:
        check_ordinals(records)
    firsts = first_ordinals(records, key)
    if existing is None:
        firsts = workspace.write(firsts.withColumn("is_new", F.lit(True)), "firsts")
    else:
        found = workspace.save(firsts, "found")
        stored = existing(found.df.select(key)) if callable(existing) else existing
        firsts = workspace.write(_mark_new(found, stored, key), "firsts")
    contested = F.expr("copies > 1 OR NOT is_new")
    size = F.octet_length(key) + 16
    total, placed, new, keys, key_bytes = firsts.agg(
        F.coalesce(F.sum("copies"), F.lit(0)),
        F.coalesce(F.sum("placed"), F.lit(0)),
        F.count_if("is_new"),
        F.count_if(contested),
        F.coalesce(F.sum(F.when(contested, size)), F.lit(0)),
    ).head()
    if placed < total:
        raise ValueError(f"{total - placed} records have no {ROW_ORD}")
    winners = firsts.where("is_new").select(ROW_ORD)
    loser_count = total - new
    losers = None
    if loser_count <= workspace.max_rows:
        table = workspace.table(firsts.where(contested), (keys, key_bytes))
        losers = workspace.write(_losers(records, table, key), "losers")
    return Selection(records, winners, losers, loser_count)


def _mark_new(found: Table, existing: DataFrame, key: str) -> DataFrame:
    stored = known(existing.select(key), found, [key]).withColumn("stored", F.lit(True))
    if found.fits_broadcast():
        stored = F.broadcast(stored)  # a subset of the measured keys
    return found.df.join(stored, key, "left").select(key, ROW_ORD, "copies", "placed", F.col("stored").isNull().alias("is_new"))


def _losers(records: DataFrame, contested: Table, key: str) -> DataFrame:
    """Ordinals of all records of contested keys but the winners. Each contested key has a
    loser, so there are no more keys than losers, and the records need not be shuffled."""
    side = contested.df.select(F.col(key).alias("_key"), F.col(ROW_ORD).alias("_first"), "is_new")
    if contested.fits_broadcast():
        side = F.broadcast(side)
    joined = records.select(key, ROW_ORD).join(side, F.col(key).eqNullSafe(F.col("_key")))
    return joined.where(~F.col("is_new") | (F.col(ROW_ORD) > F.col("_first"))).select(ROW_ORD)
