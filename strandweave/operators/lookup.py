"""Attach ids by natural key, or attributes by id, without skewed shuffles.

A lookup table that measures small is broadcast.  A larger one is joined in two steps:
its most frequent keys (at most ``HEAVY_KEYS`` rows) are broadcast, and only the rows that
found nothing there keep their key for the shuffled join.  The others are spread evenly, so
that no key can fill one partition: a key outside the heaviest k holds at most 1/(k+1) of
the rows.  Heavy texts are ranked, sent and met by a digest of fixed width, so their length
does not matter; rows whose values are longer than ``HEAVY_VALUE_BYTES`` are not sent, which
bounds what is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from strandweave.tables import Table

HEAVY_KEYS = 1024
HEAVY_VALUE_BYTES = 16 * 1024
SPREAD = 1 << 16


@dataclass(frozen=True)
class Lookup:
    """Match ``key`` of the facts to unique ``dim_key``; ``values`` maps new name -> dim column."""

    dim: Table
    key: str
    dim_key: str
    values: Mapping[str, str]


def attach(facts: DataFrame, lookups: Sequence[Lookup], spread_by: str) -> DataFrame:
    """Left-join every lookup to ``facts``; rows without a match get nulls.

    ``spread_by`` is a column of ``facts`` with many values, used to spread heavy keys.
    """
    result = facts
    for index, lookup in enumerate(lookups):
        if lookup.dim.fits_broadcast():
            result = _attach_small(result, lookup, index)
        else:
            result = _attach_large(result, facts, lookup, index, spread_by)
    return result


def _short(key: Column, data_type: T.DataType) -> Column:
    """A key of fixed width that is equal when the keys are."""
    return F.sha2(key, 256) if isinstance(data_type, T.StringType) else key


def heavy_keys(facts: DataFrame, key: str, count: int = HEAVY_KEYS) -> DataFrame:
    """The most frequent keys in short form, at most ``count`` of them (a merge of bounded top lists)."""
    short = _short(F.col(key), facts.schema[key].dataType).alias(key)
    keys = facts.where(F.col(key).isNotNull()).select(short)
    counted = keys.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), F.col(key)).limit(count).select(key)


def _value_bytes(dim: DataFrame, lookup: Lookup) -> Column:
    texts = [F.coalesce(F.octet_length(column), F.lit(0)) for column in lookup.values.values()
             if isinstance(dim.schema[column].dataType, T.StringType)]
    return sum(texts, F.lit(0))


def _side(dim: DataFrame, lookup: Lookup, key_name: str, prefix: str = "") -> DataFrame:
    columns = [F.col(column).alias(prefix + name) for name, column in lookup.values.items()]
    return dim.select(F.col(lookup.dim_key).alias(key_name), *columns)


def _attach_small(result: DataFrame, lookup: Lookup, index: int) -> DataFrame:
    key_name = f"_key{index}"
    side = F.broadcast(_side(lookup.dim.df, lookup, key_name))
    return result.join(side, F.col(lookup.key) == F.col(key_name), "left").drop(key_name)


def _attach_large(result: DataFrame, facts: DataFrame, lookup: Lookup, index: int, spread_by: str) -> DataFrame:
    heavy_name, cold_name, joined_name = f"_heavy{index}", f"_cold{index}", f"_joined{index}"
    heavy_prefix, cold_prefix = f"_h{index}_", f"_c{index}_"

    keys = heavy_keys(facts, lookup.key).select(F.col(lookup.key).alias(heavy_name))
    dim, data_type = lookup.dim.df, result.schema[lookup.key].dataType
    dim_short = _short(F.col(lookup.dim_key), dim.schema[lookup.dim_key].dataType)
    heavy = dim.where(_value_bytes(dim, lookup) <= HEAVY_VALUE_BYTES).join(F.broadcast(keys), dim_short == F.col(heavy_name), "left_semi")
    sent = [F.col(column).alias(heavy_prefix + name) for name, column in lookup.values.items()]
    heavy_side = F.broadcast(heavy.select(dim_short.alias(heavy_name), *sent))
    tagged = result.join(heavy_side, _short(F.col(lookup.key), data_type) == F.col(heavy_name), "left")

    # Rows already answered, or without a key, get a filler instead. A filler that happens
    # to equal a real key does no harm: the heavy side's answer is used, see below.
    answered = F.col(heavy_name).isNotNull()
    searching = F.col(lookup.key).isNotNull() & ~answered
    filler = _filler(data_type, spread_by)
    tagged = tagged.withColumn(cold_name, F.when(searching, F.col(lookup.key)).otherwise(filler))
    cold_side = _side(lookup.dim.df, lookup, joined_name, cold_prefix)
    joined = tagged.join(cold_side, F.col(cold_name) == F.col(joined_name), "left")

    kept = [F.col(name) for name in result.columns]
    values = [
        F.when(answered, F.col(heavy_prefix + name)).when(searching, F.col(cold_prefix + name)).alias(name)
        for name in lookup.values
    ]
    return joined.select(*kept, *values)


def _filler(data_type: T.DataType, spread_by: str) -> Column:
    number = F.pmod(F.xxhash64(spread_by), F.lit(SPREAD))
    if isinstance(data_type, T.StringType):
        return F.concat(F.lit("\u0000"), number.cast("string"))
    return (-1 - number).cast(data_type)


def known(existing: DataFrame, keys: Table, on: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` (unique per key) whose key occurs in ``keys`` (unique too).

    For a batch that measures small the stored table is only scanned, never shuffled.
    """
    wanted = keys.df.select(*on)
    if keys.fits_broadcast():
        wanted = F.broadcast(wanted)
    return existing.join(wanted, list(on), "left_semi")


def not_stored(rows: Table, existing: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows (unique per key) whose key ``existing`` does not hold yet."""
    stored = known(existing.select(*on), rows, on)
    if rows.fits_broadcast():
        stored = F.broadcast(stored)  # a subset of the measured rows
    return rows.df.join(stored, list(on), "left_anti")
