"""Dense ordinals for the rows of any source, in a given order, without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from strandweave.tables import Workspace


def assign_ordinals(df: DataFrame, order_by: Sequence[Column | str], workspace: Workspace, name: str = "row_ord") -> DataFrame:
    """``df`` with ``name``: 0, 1, 2 ... in the order of ``order_by``.

    Rows are range-partitioned, sorted and written once.  What is then summed up is one count
    per written partition, so the only row that sees all others is one per task.  Rows that
    ``order_by`` does not tell apart get different ordinals in an order of Spark's choosing.
    """
    place, first, offset = "_ord_place", "_ord_first", "_ord_offset"
    taken = {column.lower() for column in df.columns}
    if taken & {name.lower(), place, first, offset, "_ord_part", "_ord_n"}:
        raise ValueError(f"columns {sorted(taken)} hold a name that is needed here")
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    written = workspace.write(ordered.withColumn(place, F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(F.col(place), 33).alias("_ord_part")
    counts = written.groupBy(part).agg(F.min(place).alias(first), F.count(F.lit(1)).alias("_ord_n"))
    before = Window.orderBy("_ord_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_ord_part", (F.coalesce(F.sum("_ord_n").over(before), F.lit(0)) - F.col(first)).alias(offset))
    # One row per task that wrote: no larger than Spark's own list of tasks.
    numbered = written.withColumn("_ord_part", part).join(F.broadcast(offsets), "_ord_part")
    return numbered.select(*df.columns, (F.col(place) + F.col(offset)).alias(name))
