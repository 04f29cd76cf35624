"""Cards by what their lists hold: bitmaps against plain sets."""

import pytest
from pyspark.sql import functions as F
from records import frame, record

from strandweave import SegmentStore, load_batch
from strandweave.operators.bitmaps import owner_words, owners_with
from strandweave.plans.containment import WORDS, cards_with, index_lists
from strandweave.plans.load import compact_model
from strandweave.plans.schema import TYPE

# More than two words of 64, and lists of every mixture of three items.
LISTS = {n: {item for bit, item in enumerate("ABC") if n >> bit & 1} for n in range(150)}


def stored(spark, workspace, parts):
    store, start = SegmentStore(spark, workspace.folder("store")), 0
    for size in parts:
        rows = [record(f"u{n}", types=", ".join(sorted(LISTS[n])) or None) for n in range(start, start + size)]
        load_batch(store, frame(spark, rows, start=start), workspace)
        start += size
    return store


def ids(df):
    found = [row.card_id for row in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_filters_over_segments(spark, workspace):
    store = stored(spark, workspace, [70, 80])  # word 1 has cards of both batches
    with pytest.raises(ValueError):
        cards_with(store, TYPE)
    index_lists(store)
    for all_of, none_of, only in (((), (), None), (("A", "B"), (), None), ((), ("C",), None), (("A",), ("B",), ("A", "C")), ((), (), ()),
                                  (("A", "Z"), (), None), ((), ("Z",), ("A", "Z")), (("A", "A"), (), None)):
        wanted = {n for n, held in LISTS.items() if set(all_of) <= held and not held & set(none_of) and (only is None or held <= set(only))}
        assert ids(cards_with(store, TYPE, all_of, none_of, only)) == wanted, (all_of, none_of, only)
    before = ids(cards_with(store, TYPE, ["A"]))
    index_lists(store)  # nothing left to do
    compact_model(store)
    index_lists(store)
    assert ids(cards_with(store, TYPE, ["A"])) == before


def test_an_attempt_that_failed_is_repeated(spark, workspace):
    store = stored(spark, workspace, [20])
    index_lists(store)
    segment = store.manifest()["segments"][0]
    done = store._path("tables", WORDS, f"segment={segment}", "_SUCCESS")
    store._filesystem().delete(done, False)
    index_lists(store)
    assert ids(cards_with(store, TYPE, ["A"])) == {n for n in range(20) if "A" in LISTS[n]}


def test_plan_has_no_join(spark, workspace):
    store = stored(spark, workspace, [40])
    index_lists(store)
    plan = cards_with(store, TYPE, ["A"], ["B"], ["A", "C"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashJoin") == plan.count("MergeJoin") == plan.count("NestedLoopJoin") == 0
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan parquet") == 2


def test_words_of_odd_ids(spark):
    rows = spark.createDataFrame([(-1, 5), (-64, 5), (-65, 5), (63, 5), (64, 5), (64, 5), (None, 5), (1 << 40, 5)], "o long, item_id long")
    words = owner_words(rows, "o", "item_id")
    everyone = owner_words(rows, "o")
    assert {r.o for r in owners_with(everyone, words, "o", [5]).collect()} == {-1, -64, -65, 63, 64, 1 << 40}
    assert owners_with(everyone, words, "o", none_of=[5]).count() == 0
    assert owners_with(everyone, words.where(F.lit(False)), "o", only=[]).count() == 6
    assert owners_with(everyone.where(F.lit(False)), words.where(F.lit(False)), "o", [5]).count() == 0
