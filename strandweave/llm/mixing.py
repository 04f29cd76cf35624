"""Mixing sources to target weights: floor(rate) copies of each document and one coin toss.

Words are summed per source, a rate (target / size) follows for each source, and a document
is emitted floor(rate) times, plus once more if its coin falls below the fraction of the rate.
The coin is a linear hash of the document's digest with a seed; of ``SEEDS`` seeds each source
uses the one whose tosses bring its words nearest to the target, so that a few long documents
do not carry a source away from it.  Every seed's toss has the fraction as its probability.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from strandweave.llm.common import BLANKS, text_or_empty
from strandweave.operators.lookup import Lookup, attach
from strandweave.operators.ordinals import assign_ordinals
from strandweave.tables import Table, Workspace

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
SEEDS = 64
MODULUS = (1 << 31) - 1
MULTIPLIER, INCREMENT = 16807, 48271


@dataclass(frozen=True)
class Plan:
    """``documents``: key, size, coin and source of each document; ``sources``: a target and rate each."""

    documents: DataFrame
    sources: Table


def seeds(count: int = SEEDS) -> list[tuple[int, int]]:
    """Factor and addend of each seed: powers of two generators."""
    return [(pow(MULTIPLIER, k, MODULUS), pow(INCREMENT, k, MODULUS)) for k in range(1, count + 1)]


def _toss(coin: Column, factor: Column, addend: Column) -> Column:
    """In [0, 1)"""
    return ((coin * factor + addend) % F.lit(MODULUS)).cast("double") / F.lit(float(MODULUS))


def _columns() -> list[Column]:
    """Size in words, coin (31 bits of the digest of id and text) and source key, null last."""
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text_or_empty()))
    return [
        F.regexp_count(text_or_empty(), F.lit(f"[^{BLANKS}]+")).cast("long").alias("size"),
        F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").bitwiseAND(MODULUS).alias("coin"),
        F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source"))).alias("source_key"),
    ]


def _level(sources: DataFrame, share: float, most: int) -> float:
    """Target per unit of weight such that all targets, none above ``most`` sizes, sum to the share.

    Each round is one aggregate over the sources; capped sources stay capped as the level rises.
    """
    level = None
    while True:
        capped = F.lit(False) if level is None else F.lit(level) * F.col("weight") > most * F.col("source_size")
        row = sources.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(capped, most * F.col("source_size")).otherwise(0)).alias("caps"),
            F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("weights"),
        ).head()
        if not row.weights:
            return level or 0.0
        following = (row.total * share - row.caps) / row.weights
        if level is not None and following <= level:
            return level
        level = following


def plan_mix(docs: DataFrame, workspace: Workspace, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
             most: int = MOST_REPEATS, count: int = SEEDS) -> Plan:
    """Sizes of all documents and the rate, target and seed of every source."""
    narrow = workspace.write(docs.select(F.col("doc_id"), *_columns()), "sizes")
    totals = narrow.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    ranked = assign_ordinals(totals, ["source_key"], workspace, "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighted = workspace.save(ranked.select("source_key", "source_size", weight.alias("weight")), "sources").df
    level = _level(weighted, share, most)
    target = F.least(F.lit(level) * F.col("weight"), (most * F.col("source_size")).cast("double"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = workspace.save(
        weighted.withColumn("target", target).withColumn("rate", rate)
        .select("source_key", "source_size", "target", F.floor("rate").alias("whole"), (F.col("rate") - F.floor("rate")).alias("fraction")),
        "rates",
    )
    values = ["source_size", "target", "whole", "fraction"]
    documents = attach(narrow, [Lookup(rated, "source_key", "source_key", {v: v for v in values})], "coin")
    # One pass tries all seeds: a sum per seed and source, added up in every task before the shuffle.
    sums = documents.groupBy("source_key").agg(*[
        F.sum(F.when(_toss(F.col("coin"), F.lit(a), F.lit(b)) < F.col("fraction"), F.col("size")).otherwise(0)).alias(f"extra{k}")
        for k, (a, b) in enumerate(seeds(count))
    ])
    distance = [
        F.struct(F.abs(F.col("whole") * F.col("source_size") + F.col(f"extra{k}") - F.col("target")).alias("off"),
                 F.lit(k).alias("seed"), F.lit(a).cast("long").alias("factor"), F.lit(b).cast("long").alias("addend"))
        for k, (a, b) in enumerate(seeds(count))
    ]
    chosen = rated.df.join(sums, "source_key").withColumn("best", F.least(*distance))
    sources = workspace.save(chosen.select("source_key", *values, "best.seed", "best.factor", "best.addend"), "sources_seeded")
    return Plan(narrow, sources)


def _with_copies(documents: DataFrame, plan: Plan) -> DataFrame:
    values = ["source_size", "target", "whole", "fraction", "factor", "addend"]
    found = attach(documents, [Lookup(plan.sources, "source_key", "source_key", {v: v for v in values})], "coin")
    once_more = (_toss(F.col("coin"), F.col("factor"), F.col("addend")) < F.col("fraction")).cast("long")
    return found.withColumn("copies", F.col("whole") + once_more)


def taken_words(docs: DataFrame, workspace: Workspace, **options) -> DataFrame:
    """Per document: its size, its source's size and target, and the words the mix takes of it.

    A null text has no words, and so has an empty one; a null source is a source of its own,
    the last.  Rows that repeat share their coin.  An empty table gives no rows.
    """
    plan = plan_mix(docs, workspace, **options)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return _with_copies(plan.documents, plan).select("doc_id", "size", "source_size", "target", taken)


def mix(docs: DataFrame, workspace: Workspace, **options) -> DataFrame:
    """The mixed corpus: each row of ``docs``, all its columns kept, as often as the mix takes it."""
    plan = plan_mix(docs, workspace, **options)
    rows = docs.select(F.struct("*").alias("doc"), *_columns())
    copied = _with_copies(rows, plan).where(F.col("copies") > 0)
    return copied.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("doc.*")
