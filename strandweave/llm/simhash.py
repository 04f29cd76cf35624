"""Near-duplicates by SimHash, found through tables of distances to reference fingerprints.

For every distinct fingerprint its Hamming distances to many fixed references are computed
once, on the whole 64 bits and on each quarter of them.  Two fingerprints that differ in two
bits or fewer agree on two quarters, hence in all distances of those quarters, so cells keyed
by the distances of two quarters miss no pair.  In a cell, pairs whose distances to any
reference differ by more than two are discarded, and the survivors' bits are compared.

A cell with many members does not compare pairs: each member enters itself and the
fingerprints one bit away as further references (distances 0 and 1).  Members that meet at a
reference differ in two bits at most, and all that do so meet.  They are tied to the least
member there, which keeps components whole with a number of rows that is linear in the members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from strandweave.llm.common import SMALL_BATCHES, located, look_up, settings
from strandweave.llm.components import components
from strandweave.tables import Workspace

SHINGLE_WORDS = 3
SEED = 42
REACH = 2
QUARTER_REFERENCES = 12
WHOLE_REFERENCES = 8
CROWDED = 24
CHUNK = 1 << 15


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def reference(number: int) -> int:
    """The references are fixed: digests of their numbers."""
    return xxhash.xxh64_intdigest(number.to_bytes(8, "little"), SEED)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Majority of the bits of all shingles' hashes; signed."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and the six blanks
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[k:] for k in range(words))))
    count = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype=np.uint64, count=count)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, count, CHUNK):
        bits = np.unpackbits(hashes[start:start + CHUNK].view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.uint32)
    chosen = np.packbits((2 * ones > count).astype(np.uint8), bitorder="little")
    return int(chosen.view("<i8")[0])


def with_fingerprint(text: Column, words: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("bigint")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(text, words) for text in batch], dtype="int64")

    return fingerprints(text)


def _distance(bits: Column, number: int, mask: int) -> Column:
    other = bits.bitwiseXOR(F.lit(_signed(reference(number))).cast("long"))
    return F.bit_count(other.bitwiseAND(F.lit(_signed(mask)).cast("long")))


def pivot_table(prints: DataFrame) -> DataFrame:
    """Per fingerprint: eight distances on all bits, a byte each in ``whole``, and those per quarter."""
    bits = F.col("bits")
    whole = F.lit(0).cast("long")
    for k in range(WHOLE_REFERENCES):
        whole = whole.bitwiseOR(F.shiftleft(_distance(bits, k, (1 << 64) - 1).cast("long"), 8 * k))
    quarters = [
        F.array(*[_distance(bits, 100 * (q + 1) + k, 0xFFFF << (16 * q)) for k in range(QUARTER_REFERENCES)]).alias(f"quarter{q}")
        for q in range(4)
    ]
    return prints.select("bits", whole.alias("whole"), *quarters)


def _cells(prints: DataFrame) -> DataFrame:
    """Six rows per fingerprint: the cell of each two quarters, and the bits outside them."""
    cells = []
    for a in range(4):
        for b in range(a + 1, 4):
            outside = ((1 << 64) - 1) & ~((0xFFFF << (16 * a)) | (0xFFFF << (16 * b)))
            key = F.xxhash64(F.lit(4 * a + b), F.col(f"quarter{a}"), F.col(f"quarter{b}"))
            cells.append(F.struct(key.alias("cell"), F.lit(_signed(outside)).cast("long").alias("outside")))
    exploded = pivot_table(prints).select("bits", "whole", F.explode(F.array(*cells)).alias("c"))
    return exploded.select("bits", "whole", "c.cell", "c.outside")


def links(prints: DataFrame, workspace: Workspace, crowded: int = CROWDED) -> DataFrame:
    """(u, v) over distinct fingerprints (``bits``): enough links to tie every class together."""
    cells = workspace.write(_cells(prints), "cells")
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = look_up(cells, sizes, "cell", {"members": "members"}, "bits", workspace).where("members > 1")
    members = workspace.write(members, "members")

    few = members.where(F.col("members") <= crowded)
    left = few.select("cell", F.col("bits").alias("u"), F.col("whole").alias("whole_u"))
    right = few.select("cell", F.col("bits").alias("v"), F.col("whole").alias("whole_v"))
    coordinates = [
        F.abs(F.shiftright("whole_u", 8 * k).bitwiseAND(255) - F.shiftright("whole_v", 8 * k).bitwiseAND(255))
        for k in range(WHOLE_REFERENCES)
    ]
    survives = F.greatest(*coordinates) <= REACH
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= REACH
    pairs = left.join(right, "cell").where((F.col("u") > F.col("v")) & survives & close).select("u", "v")

    flips = F.array(*[F.lit(_signed(1 << k)).cast("long") for k in range(64)])
    own = F.filter(flips, lambda bit: bit.bitwiseAND(F.col("outside")) != 0)
    met = members.where(F.col("members") > crowded).select(
        "cell", "bits", F.explode(F.concat(F.array(F.lit(0).cast("long")), own)).alias("flip"))
    met = met.select("cell", "bits", F.col("bits").bitwiseXOR(F.col("flip")).alias("at"))
    least = F.min("bits").over(Window.partitionBy("cell", "at"))  # 33 fingerprints can meet there at most
    tied = met.select(F.col("bits").alias("u"), least.alias("v")).where("u <> v")
    return pairs.unionByName(tied).distinct()


def near_groups(docs: DataFrame, workspace: Workspace, words: int = SHINGLE_WORDS, crowded: int = CROWDED) -> DataFrame:
    """One row per document: file, row, doc_id, bits, component_id.

    Null and empty texts have fingerprint zero and are linked like any other; a text with fewer
    words than a shingle is one shingle.  ``component_id`` is the least id of the component (null
    only if none of its rows has one).  Rows that repeat share everything.  An empty table gives
    no rows.  Only ``doc_id`` and ``text`` are read.
    """
    return _near_groups(located(docs, workspace), workspace, words, crowded)


def _near_groups(source: DataFrame, workspace: Workspace, words: int, crowded: int) -> DataFrame:
    marked = source.select("file", "row", F.col("doc.doc_id").alias("doc_id"), with_fingerprint(F.col("doc.text"), words).alias("bits"))
    with settings(source.sparkSession, SMALL_BATCHES):
        prints = workspace.write(marked, "prints")
    distinct = workspace.write(prints.groupBy("bits").agg(F.min("doc_id").alias("least_id")), "distinct")
    roots = components(links(distinct, workspace, crowded), workspace)
    rooted = look_up(distinct, roots.withColumnRenamed("node", "bits"), "bits", {"root": "root"}, "least_id", workspace)
    rooted = workspace.write(rooted.withColumn("root", F.coalesce("root", "bits")), "rooted")
    classes = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(classes, "root").select("bits", "component_id", "root")
    return look_up(prints, named, "bits", {"component_id": "component_id", "root": "root"}, "row", workspace)


def fingerprint_components(docs: DataFrame, workspace: Workspace, **options) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document."""
    found = near_groups(docs, workspace, **options)
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, workspace: Workspace, words: int = SHINGLE_WORDS, crowded: int = CROWDED) -> DataFrame:
    """``docs``, all columns kept, with the row of the least id of each component only.

    Null and empty texts are equal and one of them stays.  Rows without an id come last in the
    order; of rows that repeat the first in place stays.  An empty table gives no rows.
    """
    source = located(docs, workspace)
    found = workspace.write(_near_groups(source, workspace, words, crowded), "near")
    # The first row of a component: least id, then place; reduced in the tasks, so no group is gathered.
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")
    stay = found.groupBy("root").agg(F.min(order).alias("first")).select("first.file", "first.row")
    return source.join(stay, ["file", "row"], "left_semi").select("doc.*")
