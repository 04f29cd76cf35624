"""Flat CSV files into a staging table of texts with a record ordinal.

Reading keeps an unquoted empty field (null) apart from a quoted one (empty text), accepts
doubled quotes and line feeds inside quotes, and fails on a record of the wrong width and on
a file whose header differs.  Blank lines are skipped, as Spark's CSV source does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from strandweave.fixed import ROW_ORD
from strandweave.sources.store import SegmentStore
from strandweave.tables import Table

# No field can equal this, so only a really missing field becomes null.
_NULL_MARK = "\u0001\u0002null\u0002\u0001"
_FORMAT = {"escape": '"', "encoding": "UTF-8", "mode": "FAILFAST"}

RECORDS, RAW = "records", "raw"


def _header(spark: SparkSession, path: str) -> list[str]:
    """The first file's header as it stands."""
    first = min(spark.read.format("text").load(path).inputFiles(), default=None)
    header = first and spark.read.options(header=False, multiLine=True, **_FORMAT).csv(first).head()
    if not header:
        raise ValueError(f"no header in {path}")
    return ["" if name is None else name for name in header]


def header_schema(spark: SparkSession, path: str) -> T.StructType:
    """All-text schema named by the first file's header, names stripped."""
    names = [name.strip() for name in _header(spark, path)]
    if "" in names or len(set(names)) < len(names):
        raise ValueError(f"header names must be distinct and not empty: {names}")
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """Fields by position, all text.

    A multi-line file is read by one task; for large inputs use many files, or
    ``multi_line=False`` where no field contains a line feed, which lets files be split.
    """
    options = dict(_FORMAT, header=True, multiLine=multi_line, nullValue=_NULL_MARK)
    if schema is not None:
        return spark.read.schema(schema).options(**options).csv(path)
    source, columns = _checked(spark, path, options)
    return source.select(*columns)


def _checked(spark: SparkSession, path: str, options: dict) -> tuple[DataFrame, list[Column]]:
    """A scan that holds every file's header against the first one's, blanks and all, and its
    columns under stripped names."""
    names, printed = header_schema(spark, path).names, _header(spark, path)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in printed])
    source = spark.read.schema(schema).options(**options, enforceSchema=False).csv(path)
    return source, [F.col(f"`{old}`").alias(new) for old, new in zip(printed, names)]


def stage_csv(spark: SparkSession, path: str, store: SegmentStore, multi_line: bool = True) -> DataFrame:
    """Replace the staging table in ``store`` with the records of ``path``.

    Ordinals follow file path, then place in the file.  The records are parsed once, each
    written with the split it came from and its place in the task; records are counted per
    split, and the table is written again with ordinals, so that whoever reads it only scans.
    Nothing depends on a split being read the same way twice.
    """
    manifest = store.manifest()
    segment = store.new_segment()
    options = dict(_FORMAT, header=True, multiLine=multi_line, nullValue=_NULL_MARK)
    source, columns = _checked(spark, path, options)
    store.write(segment, RAW, source.select(
        *columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"),
    ))
    written = store.read_segment(segment, RAW)
    splits = written.groupBy("_file", "_block").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row per file split: the list Spark's own driver holds to plan the scan.
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
    splits = Table(offsets.select("_file", "_block", "_offset"))
    side = F.broadcast(splits.df) if splits.fits_broadcast() else splits.df
    ordinal = (F.col("_place") + F.col("_offset")).alias(ROW_ORD)
    names = [name for name in written.columns if name not in ("_file", "_block", "_place")]
    placed = written.join(side, ["_file", "_block"]).select(ordinal, *[F.col(f"`{name}`") for name in names])
    store.write(segment, RECORDS, placed)
    store.drop(segment, RAW)
    store.publish(segment, after=manifest, replace=True)
    return read_staging(store)


def read_staging(store: SegmentStore) -> DataFrame:
    """The staged records with their dense ordinal, in ``row_ord``: a plain scan."""
    return store.read_segment(store.manifest()["segments"][0], RECORDS)
