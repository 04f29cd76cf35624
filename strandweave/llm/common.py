"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strandweave.operators.lookup import Lookup, attach
from strandweave.tables import Workspace

# The characters that separate words, as a class for regular expressions (fixed value).
BLANKS = r"\x20\x09-\x0D"


# Whole texts go to Python tasks in small batches, so that their memory stays bounded.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the actions inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def located(docs: DataFrame, workspace: Workspace) -> DataFrame:
    """Every row as ``doc`` (a struct of its columns) with a locator that survives re-reading.

    The locator is the row's file and place in it.  A plan that is not a plain file scan is
    written once, and the copy's files count.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    if "_metadata" not in {name.lower() for name in docs.columns}:
        try:
            return docs.select(F.struct("*").alias("doc"), *place)
        except AnalysisException:
            pass  # not a scan of files: there is no such metadata
    copy = workspace.write(docs.select(F.struct("*").alias("doc")), "copy")
    return copy.select("doc", *place)


def look_up(facts: DataFrame, dim: DataFrame, key: str, values: dict[str, str], spread_by: str, workspace: Workspace) -> DataFrame:
    """Left join to ``dim`` (unique ``key``), safe for hot keys; ``dim`` is saved and measured."""
    columns = [key, *values.values()]
    saved = workspace.save(dim.select(*dict.fromkeys(columns)), "lookup")
    return attach(facts, [Lookup(saved, key, key, values)], spread_by)
