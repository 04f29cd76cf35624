import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from strandweave.llm import exact_dedup
from strandweave.tables import Workspace


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def by_hand(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[normal(r.text)].append(r)
    for key, members in groups.items():
        best = min(members, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        yield key, best.doc_id, members


def check(docs, rows):
    wanted = []
    for key, keep, members in by_hand(docs.collect()):
        digest = hashlib.sha256(key.encode()).hexdigest()
        wanted += [(str(m.doc_id), str(keep), len(members), digest) for m in members]
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.digest) for r in rows) == sorted(wanted)
    kept = defaultdict(list)
    for r in rows:
        kept[r.digest] += [r.doc_id] if r.kept else []
        assert not r.kept or r.doc_id == r.keep_id
    assert all(len(ids) == 1 for ids in kept.values())


def test_edge_documents(spark, edge_documents, no_documents):
    check(edge_documents, exact_dedup.exact_groups(edge_documents, Workspace(spark)).collect())
    assert exact_dedup.exact_groups(no_documents, Workspace(spark)).collect() == []
    assert exact_dedup.drop_exact_duplicates(no_documents, Workspace(spark)).collect() == []
    left = exact_dedup.drop_exact_duplicates(edge_documents, Workspace(spark))
    assert left.columns == edge_documents.columns
    assert sorted(normal(r.text) for r in left.collect()) == sorted(key for key, _, _ in by_hand(edge_documents.collect()))


def test_later_batches_improve_the_state(spark):
    """One file per batch: a longer original that arrives late stays instead of the first."""
    docs = spark.createDataFrame([(i, "same" + " " * (i % 7)) for i in range(40)] + [(100 + i, f"t{i}") for i in range(9)], "doc_id bigint, text string").repartition(5)
    check(docs, exact_dedup.exact_groups(docs, Workspace(spark), files_per_batch=1).collect())


def test_equal_digests_of_unequal_texts(spark, edge_documents):
    """A digest of a few bits: texts that only share it are told apart by their bytes."""
    weak = lambda text: F.substring(F.sha2(text, 256), 1, 1)
    rows = exact_dedup.exact_groups(edge_documents, Workspace(spark), digest=weak).collect()
    wanted = sorted((str(m.doc_id), str(keep), len(members)) for _, keep, members in by_hand(edge_documents.collect()) for m in members)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in rows) == wanted
    assert sum(r.kept for r in rows) == len({key for key, _, _ in by_hand(edge_documents.collect())})


def test_state_lies_on_disk_and_claims_little_of_it():
    assert exact_dedup.STATE["spark.sql.streaming.stateStore.providerClass"].endswith("RocksDBStateStoreProvider")
    assert exact_dedup.STATE["spark.sql.streaming.stateStore.rocksdb.allowFAllocate"] == "false"
