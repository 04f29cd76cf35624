"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs twice from nothing into a sink that reads every row; the better time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strandweave import SegmentStore, Workspace, card_profile, load_batch, open_model  # noqa: E402
from strandweave.catalog import QUERIES  # noqa: E402
from strandweave.catalog.queries import staging  # noqa: E402
from strandweave.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "card_profile", "incremental_load", "doc_tokens", "html_tag_pips", "fact_cards", "first_wins_cards",
    "load_status", "bridge_ability", "agg_subtypes", "name_set_bridge", "identity_within", "cost_totals",
    "profile_by_id", "profile_view", "model_integrity", "ordinals_assigned", "load_rejected", "stream_incremental_load",
    "dq_not_null", "dq_fk", "dq_pairs", "csv_roundtrip", "stream_running_total", "stream_get_or_insert", "stream_tokens",
)


def read_all(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def shuffle_bytes(spark) -> int:
    """Bytes of shuffle output of all stages so far, from the session's status store."""
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(
        None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None
    )
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def main() -> None:
    spark = local_session(CPUS, memory="16g", **{"spark.ui.retainedStages": "100000"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    shuffled: dict[str, int] = {}

    def measure(name, action) -> None:
        try:
            before = shuffle_bytes(spark)
        except Exception:
            before = None
        best = None
        for _ in range(2):
            start = time.perf_counter()
            action()
            elapsed = time.perf_counter() - start
            best = elapsed if best is None else min(best, elapsed)
        seconds[name] = round(best, 3)
        if before is not None:
            shuffled[name] = (shuffle_bytes(spark) - before) // 2

    with Workspace(spark) as workspace:
        records = workspace.write(staging(spark, SF_DIR).repartitionByRange(int(CPUS), "row_ord"), "staging")
        rows_in = records.count()
        store = SegmentStore(spark, workspace.folder("store"))

        def build() -> None:
            with Workspace(spark) as scratch:
                load_batch(store, records, scratch, replace=True)

        measure("build_model", build)
        measure("profile_stored", lambda: read_all(card_profile(open_model(spark, store, workspace))))
        rows_out = card_profile(open_model(spark, store, workspace)).count()
    for name in HEADLINE:
        measure(name, lambda: read_all(QUERIES[name](spark, SF_DIR)))

    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rstrip("/").split("sf")[-1],
        "cpus": int(CPUS),
        "rows": {"staging": rows_in, "profile": rows_out},
        "shuffle_bytes": shuffled,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
