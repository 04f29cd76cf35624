import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandweave.llm.mixing import mix, taken_words
from strandweave.tables import Workspace


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets_by_hand(rows):
    """Targets by sharing out, source by source, until none is above twice its size."""
    sizes = Counter()
    for source, size in rows:
        sizes[source] += size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weights[s] for s in open_)
        above = {s for s in open_ if level * weights[s] > 2 * sizes[s]}
        if not above:
            target.update({s: level * weights[s] for s in open_})
            break
        target.update({s: 2.0 * sizes[s] for s in above})
        left -= sum(2 * sizes[s] for s in above)
        open_ -= above
    return sizes, target


def check(spark, docs):
    wanted = [(r.doc_id, r.source, words(r.text)) for r in docs.select("doc_id", "source", "text").collect()]
    sizes, target = targets_by_hand([(source, size) for _, source, size in wanted])
    rows = taken_words(docs, Workspace(spark)).collect()
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in rows) == Counter(
        (i, n, sizes[s], round(target[s], 6)) for i, s, n in wanted)
    assert all(r.taken % max(1, r.size) == 0 and r.taken <= 2 * r.size for r in rows)
    return rows, target


def test_edge_documents(spark, edge_documents, no_documents):
    check(spark, edge_documents)
    assert taken_words(no_documents, Workspace(spark)).collect() == []
    assert mix(no_documents, Workspace(spark)).collect() == []
    mixed = mix(edge_documents, Workspace(spark))
    assert mixed.columns == edge_documents.columns


def test_taken_words_come_near_their_targets_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows, target = check(spark, docs)
    assert Counter(rows) == Counter(taken_words(docs.repartition(7), Workspace(spark)).collect())
    taken, goal = Counter(), {}
    for r in rows:
        key = (r.source_size, r.target)
        taken[key] += r.taken
        goal[key] = r.target
    assert all(abs(taken[k] - goal[k]) <= 0.05 * goal[k] + 50 for k in goal)
    copies = {r.doc_id: r.n for r in mix(docs, Workspace(spark)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert all(copies.get(r.doc_id, 0) == r.taken // r.size for r in rows if r.size)


@pytest.mark.parametrize("rows", [[("a", 1000)], [("a", 5), ("b", 5000)], [(None, 10), ("", 10), ("z", 10), ("é", 3)], [("a", 0), ("b", 0)]])
def test_few_sources(spark, rows):
    docs = spark.createDataFrame([(i, "w " * n, s) for i, (s, n) in enumerate(rows)], "doc_id bigint, text string, source string")
    check(spark, docs)
