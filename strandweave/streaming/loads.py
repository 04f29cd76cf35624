"""Incremental load from a stream of staging records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from strandweave.plans.load import load_batch
from strandweave.sources.store import SegmentStore
from strandweave.tables import Workspace


def load_stream(stream: DataFrame, store: SegmentStore, checkpoint: str, numeric_power_star: bool = False,
                divert: bool = False, **trigger) -> StreamingQuery:
    """Load every micro-batch on top of what is stored; stored keys win.

    With ``divert`` a record that cannot be loaded does not stop the stream, see ``load_batch``.

    The query's own id, which lives in its checkpoint, and the batch number are published
    with the rows, so a batch delivered again is skipped.
    """

    def load(records: DataFrame, number: int) -> None:
        if records.isEmpty():
            return
        session = records.sparkSession  # the stream's own session
        with Workspace(session) as workspace:
            # Read the source once: the load makes several passes over its records.
            batch = workspace.write(records, "records")
            query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
            load_batch(SegmentStore(session, store.root), batch, workspace, batch=f"{query}-{number}",
                       numeric_power_star=numeric_power_star, divert=divert)

    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    return writer.foreachBatch(load).trigger(**(trigger or {"availableNow": True})).start()
