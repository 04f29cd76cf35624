"""Integrity rules as queries: each returns the rows that break it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from strandweave.fixed import ROW_ORD, STAT_REVIEW
from strandweave.functions import stat_value


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; a null makes a key distinct from all others."""
    present = df.na.drop(subset=list(keys))
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def missing_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def missing_counts(df: DataFrame, columns: Sequence[str], prefix: str = "") -> DataFrame:
    """Nulls per column, all columns in one pass: (rule, violations)."""
    counted = df.agg(*[F.count_if(F.col(column).isNull()).alias(column) for column in columns])
    rules = [F.struct(F.lit(f"not null {prefix}{c}").alias("rule"), F.col(c).alias("violations")) for c in columns]
    return counted.select(F.inline(F.array(*rules)))


def dangling_references(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Referenced ids without a parent row, with the number of child rows.

    Children are counted per id before the join, so a popular id is one row in it.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return used.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def for_review(records: DataFrame, column: str) -> DataFrame:
    """Texts that are neither a number nor a known sign, as printed."""
    texts = records.where(stat_value(F.col(column)) == STAT_REVIEW)
    return texts.select(ROW_ORD, F.col(column).alias("printed"))


def orphans(dim: DataFrame, dim_id: str, fact: DataFrame, fact_id: str) -> DataFrame:
    """Dimension rows no fact refers to."""
    used = fact.where(F.col(fact_id).isNotNull()).select(F.col(fact_id).alias(dim_id)).distinct()
    return dim.join(used, dim_id, "left_anti")


def violations(rule: str, broken: DataFrame) -> DataFrame:
    """One row: the rule and how many rows break it."""
    return broken.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(rule).alias("rule"), "violations")
