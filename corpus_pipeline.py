"""The corpus pipeline: quality, exact and near duplicates, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.  All but
the last return the columns of ``documents``; the last returns the packed sequences, a row per
piece.  ``run`` writes the result of each stage to the shared folder and reads it back, so a
stage never computes an earlier one again, whatever executors are lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandweave.llm import exact_dedup, mixing, packing, quality, simhash
from strandweave.llm.common import read_table
from strandweave.llm.queries import tokenizer_path
from strandweave.tables import Workspace


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs, Workspace(spark))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints: shingles of three words, two bits or fewer apart."""
    return simhash.drop_near_duplicates(docs, Workspace(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mix(docs, Workspace(spark))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of one length with little padding."""
    return packing.pack(docs, Workspace(spark), tokenizer_path())


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Training a classifier, fingerprints and packing are beyond SQL; the tests hold the stages
# against versions of them in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, workspace = read_table(spark, sf_dir, "documents"), Workspace(spark)
    for name, stage in STAGES:
        docs = workspace.write(stage(spark, docs, sf_dir), name)
    return docs
