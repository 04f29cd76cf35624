import zlib

import numpy as np
import pytest

from strandweave.llm import quality
from strandweave.llm.common import read_table

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = read_table(spark, FOLDER, "documents"), read_table(spark, FOLDER, "labels")
    scored = quality.score_documents(docs, labels)
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    for row in scored.select("doc_id", "held_out", "score", "predicted").limit(50).collect():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert row.predicted == int(row.score >= 0.3) and 0 <= row.score <= 1
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == scored.where("predicted = 1").count()
    again = {r.doc_id: r.score for r in quality.score_documents(docs, labels).collect()}
    assert again == {r.doc_id: r.score for r in scored.collect()}


def test_edge_documents(spark, edge_documents, no_documents):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, None), (10, 0, 0), (10, 0, 0), (None, 1, 1), (11, None, 0)], "doc_id bigint, quality int, toxic int")
    rows = quality.score_documents(edge_documents, labels).collect()
    assert len(rows) == edge_documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    unlabelled = quality.score_documents(edge_documents, labels.where("false")).collect()
    assert {r.score for r in unlabelled} == {0.5}
    assert quality.score_documents(no_documents, labels).collect() == []


def test_passages_cover_the_whole_text():
    rows = quality.passages("a " * 1000)
    assert len(rows) == 16 and rows.shape[1] == quality.WIDTH
    assert not quality.passages(None).any() and not quality.passages(" \n").any()
    late = quality.passages("word " * 640 + "LOUD!! " * 64)
    assert late[-1][0] > 0.5 and late[0][0] == 0


def test_gradients():
    draw = np.random.default_rng(3)
    x, starts, labels = draw.normal(size=(12, quality.WIDTH)), np.array([0, 1, 5]), np.array([1.0, 0.0, 1.0])
    weights = np.array([0.2, 0.5, 0.3])
    model = quality.fit([x[:1], x[1:5], x[5:]], labels, weights)
    parts = {k: v.copy() for k, v in model.parts.items()}

    def loss():
        score = quality._forward(parts, x, starts)["score"]
        return -(weights * (labels * np.log(score) + (1 - labels) * np.log(1 - score))).sum()

    for name, wanted in quality._gradients(parts, x, starts, labels, weights).items():
        at = tuple(0 for _ in parts[name].shape)
        parts[name][at] += 1e-5
        up = loss()
        parts[name][at] -= 2e-5
        down = loss()
        parts[name][at] += 1e-5
        assert (up - down) / 2e-5 == pytest.approx(wanted[at], abs=1e-6)
