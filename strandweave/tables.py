"""Saved tables and the shared folder that holds them.

Results that several plans read (dictionaries, kept records) are written once as
Parquet under ``spark.checkpoint.dir`` and read back.  That cuts lineage in a place
every executor can reach, so a lost executor costs only its running tasks, and it
makes table sizes known, so a broadcast is chosen on a measured size.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

# Bounds below which a table may be broadcast: rows, and bytes of all its columns.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024


def size_measures(schema: T.StructType) -> list[Column]:
    """Row count, and bytes of the data: text length plus 8 bytes for any other column."""
    total = F.lit(0).cast("long")
    for field in schema.fields:
        if isinstance(field.dataType, T.StringType):
            total = total + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
        else:
            total = total + F.lit(8)
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(total), F.lit(0)).alias("bytes")]


class Table:
    """A stored DataFrame whose size is known or can be measured, once."""

    def __init__(self, df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES,
                 size: tuple[int, int] | None = None):
        self.df = df
        self.max_rows = max_rows
        self.max_bytes = max_bytes
        self._size = size

    @property
    def size(self) -> tuple[int, int]:
        """(rows, bytes)"""
        if self._size is None:
            self._size = tuple(self.df.agg(*size_measures(self.df.schema)).head())
        return self._size

    @property
    def rows(self) -> int:
        return self.size[0]

    def with_df(self, df: DataFrame) -> Table:
        """The same rows in another form; the measured size is kept."""
        return Table(df, self.max_rows, self.max_bytes, self.size)

    def fits_broadcast(self) -> bool:
        rows, size = self.size
        return rows <= self.max_rows and size <= self.max_bytes


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; if none is set, one in the warehouse, which is shared too."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_runs"


class Workspace:
    """A run's own folder below the shared folder."""

    def __init__(self, spark: SparkSession, root: str | None = None,
                 max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES):
        self.spark = spark
        self.path = f"{root or shared_folder(spark)}/run-{uuid.uuid4().hex}"
        self.max_rows = max_rows
        self.max_bytes = max_bytes

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"

    def table(self, df: DataFrame, size: tuple[int, int] | None = None) -> Table:
        return Table(df, self.max_rows, self.max_bytes, size)

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write ``df`` and read it back."""
        path = self.folder(name)
        df.write.partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save(self, df: DataFrame, name: str) -> Table:
        """Write ``df`` and read it back, its size taken on the way; a repeated task could
        only make it look larger, which is the safe side."""
        path = self.folder(name)
        observation = Observation()
        df.observe(observation, *size_measures(df.schema)).write.parquet(path)
        size = observation.get
        known = (size["rows"], size["bytes"]) if size else None
        return self.table(self.spark.read.schema(df.schema).parquet(path), known)

    def clear(self) -> None:
        """Delete this run's folder; only after every plan that reads it has finished."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *exc) -> None:
        self.clear()


def run_together(spark: SparkSession, actions: Mapping[str, Callable[[], object]], width: int = 8) -> dict[str, object]:
    """Run independent actions (callables) at the same time, so small jobs do not queue."""
    with ThreadPoolExecutor(max_workers=width) as pool:
        futures = {name: pool.submit(inheritable_thread_target(spark)(action)) for name, action in actions.items()}
        return {name: future.result() for name, future in futures.items()}
