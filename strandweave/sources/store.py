"""Published tables: immutable Parquet segments and a small manifest that lists them.

A load writes its new rows as a segment and publishes by adding one manifest file, so a
failed load leaves nothing visible, readers keep a consistent set of tables, and the cost
of a load follows the batch, not what is stored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class SegmentStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    # -- manifest ----------------------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _filesystem(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        filesystem = self._filesystem()
        folder = self._path("manifests")
        if not filesystem.exists(folder):
            return []
        names = [status.getPath().getName() for status in filesystem.listStatus(folder)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and not name.startswith("."))

    def manifest(self) -> dict | None:
        """The current manifest: version, segments, batches and the next free ordinal."""
        versions = self._versions()
        if not versions:
            return None
        path = f"{self.root}/manifests/{versions[-1]:010d}.json"
        return json.loads(self.spark.read.text(path, wholetext=True).head()[0])

    def publish(self, segment: str, after: dict | None = None, replace: bool = False, next_ord: int = 0,
                batch: str | None = None, sizes: Mapping[str, Sequence[int]] | None = None,
                extra: Mapping[str, object] | None = None) -> None:
        """Make ``segment`` visible. Fails if another load published since ``after`` was read.

        ``sizes`` are (rows, bytes) the segment adds to tables; the manifest keeps their sums.
        """
        version = (after["version"] if after else 0) + 1
        if replace or after is None:
            after = {"segments": [], "batches": [], "sizes": {}}
        totals = dict(after["sizes"])
        for table, (rows, size) in (sizes or {}).items():
            old_rows, old_size = totals.get(table, (0, 0))
            totals[table] = (old_rows + rows, old_size + size)
        content = {
            "version": version,
            "segments": [*after["segments"], segment],
            "batches": [*after["batches"], batch] if batch is not None else after["batches"],
            "next_ord": next_ord,
            "sizes": totals,
            **(extra or {}),
        }
        self._put(content)

    def _put(self, content: Mapping[str, object]) -> None:
        """Write a manifest as its version; fails if there is one already."""
        version = content["version"]
        filesystem = self._filesystem()
        draft = self._path("manifests", f".{uuid.uuid4().hex}")
        stream = filesystem.create(draft, False)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        # A rename without overwrite: of two writers of one version, the second fails.
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        target = self._path("manifests", f"{version:010d}.json")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            filesystem.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(filesystem.makeQualified(draft), filesystem.makeQualified(target), options)

    # -- segments: every table is partitioned by segment -------------------------------------

    def new_segment(self) -> str:
        return f"s{uuid.uuid4().hex}"

    def _folder(self, table: str, segment: str) -> str:
        return f"{self.root}/tables/{table}/segment={segment}"

    def write(self, segment: str, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        df.write.partitionBy(*partition_by).parquet(self._folder(table, segment))

    def has(self, segment: str, table: str) -> bool:
        """Whether a segment holds any rows' folder of ``table``; some tables are written only when needed."""
        return self._filesystem().exists(self._path("tables", table, f"segment={segment}"))

    def complete(self, segment: str, table: str) -> bool:
        """Whether a segment's folder of ``table`` was written to the end."""
        return self._filesystem().exists(self._path("tables", table, f"segment={segment}", "_SUCCESS"))

    def drop(self, segment: str, table: str) -> None:
        """Delete a segment's scratch table."""
        self._filesystem().delete(self._path("tables", table, f"segment={segment}"), True)

    def read_segment(self, segment: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self._folder(table, segment))

    def read(self, manifest: dict, table: str, schema: str | StructType) -> DataFrame:
        """All rows of a table that ``manifest`` lists, as one scan."""
        folders = [self._folder(table, segment) for segment in manifest["segments"]]
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/tables/{table}")
        return reader.parquet(*folders).drop("segment")

    def compact(self, tables: Mapping[str, tuple[str | StructType, Sequence[str]]]) -> None:
        """Merge all segments into one and publish it; ``tables`` gives schema and partition columns.

        What readers see does not change.  Spark sizes the files: small pieces of a partition
        are put together and large ones split.  A load published meanwhile makes this fail.
        """
        manifest = self.manifest()
        if manifest is None or len(manifest["segments"]) < 2:
            return
        segment = self.new_segment()
        for table, (schema, partition_by) in tables.items():
            rows = self.read(manifest, table, schema)
            self.write(segment, table, rows.hint("rebalance", *partition_by), partition_by)
        self._put({**manifest, "version": manifest["version"] + 1, "segments": [segment]})

    def vacuum(self) -> None:
        """Delete segments the current manifest does not list; no reader may be using them."""
        manifest = self.manifest()
        filesystem = self._filesystem()
        if manifest is None:
            return
        current = {f"segment={segment}" for segment in manifest["segments"]}
        for table in filesystem.listStatus(self._path("tables")):
            for segment in filesystem.listStatus(table.getPath()):
                if segment.getPath().getName() not in current:
                    filesystem.delete(segment.getPath(), True)
