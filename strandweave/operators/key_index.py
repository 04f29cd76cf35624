"""An access path to stored keys, so that a batch reads what its keys can meet and no more.

Every key of the model (record keys, dimension keys, name-and-set pairs) also stands in one
narrow table, laid out by a hash bucket of the key and sorted by it inside.  A batch works out
which buckets its keys fall into, at most as many numbers as there are buckets, and the scan is
pruned to those partitions; a batch of one record reads one bucket for its record key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

INDEX = "key_index"
INDEX_SCHEMA = "space string, key string, id long, bucket int"
INDEX_PARTITION = ("bucket",)
BUCKETS = 64
CARD_SPACE = "card"
NAME_SET_SPACE = "card_name_set_bridge"


def bucket_of(space: str | Column, key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(space, key), F.lit(buckets)).cast("int").alias("bucket")


def pair_key(first: str, second: str) -> Column:
    """One key for a pair: the number, then the text, so no two pairs share it."""
    return F.concat(F.col(second).cast("string"), F.lit(":"), F.col(first))


def index_rows(keys: DataFrame, buckets: int) -> DataFrame:
    """``keys`` (space, key, id) in stored form: a bucket's rows together, sorted; Spark sizes and splits the files."""
    placed = keys.select("space", "key", "id", bucket_of("space", "key", buckets))
    return placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "space", "key")


class KeyIndex:
    """The stored index of a model, read by bucket."""

    def __init__(self, rows: DataFrame, buckets: int):
        self.rows = rows
        self.buckets = buckets

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets of ``keys`` (space, key): a bounded list of numbers."""
        found = keys.select(bucket_of("space", "key", self.buckets)).distinct().collect()
        return sorted(row.bucket for row in found)

    def near(self, keys: DataFrame) -> DataFrame:
        """Stored rows (space, key, id) of the buckets of ``keys``: all that can equal one of them."""
        touched = self.touched(keys)
        rows = self.rows if len(touched) == self.buckets else self.rows.where(F.col("bucket").isin(touched))
        return rows.select("space", "key", "id")
