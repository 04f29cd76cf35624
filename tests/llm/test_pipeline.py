"""Every stage of the pipeline on what the one before kept, against versions in plain Python."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from test_exact_dedup import by_hand as equal_texts
from test_mixing import targets_by_hand, words
from test_packing import PATH
from test_simhash import by_hand as bits_of, classes
from tokenizers import Tokenizer

import corpus_pipeline
from strandweave.llm import quality
from strandweave.llm.common import read_table
from strandweave.tables import Workspace

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, found = read_table(spark, FOLDER, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = Workspace(spark).write(stage(spark, docs, FOLDER), name)
        found.append(docs)
    return [read_table(spark, FOLDER, "documents"), *found]


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "mixing", "packing"]
    assert all(stage.columns == stages[0].columns for stage in stages[1:5])


def test_rejected_documents_go(spark, stages):
    scored = quality.score_documents(stages[0], read_table(spark, FOLDER, "labels")).collect()
    assert sorted(r.doc_id for r in stages[1].collect()) == sorted(r.doc_id for r in scored if r.predicted)
    good = {r.doc_id for r in read_table(spark, FOLDER, "labels").where("quality = 1").collect()}
    assert len(good - {r.doc_id for r in stages[1].collect()}) <= 0.05 * len(good)


def test_one_of_equal_texts_stays(stages):
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(keep for _, keep, _ in equal_texts(stages[1].collect()))


def test_one_of_each_near_group_stays(stages):
    prints = [(r.doc_id, bits_of(r.text)) for r in stages[2].collect()]
    root = classes({p for _, p in prints})
    least = {}
    for i, p in prints:
        least[root[p]] = min(i, least.get(root[p], i))
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(least.values())


def test_each_document_as_often_as_its_source_asks(stages):
    docs = {r.doc_id: r for r in stages[3].collect()}
    sizes, target = targets_by_hand([(r.source, words(r.text)) for r in docs.values()])
    copies = Counter(r.doc_id for r in stages[4].collect())
    for i, r in docs.items():
        rate = target[r.source] / sizes[r.source]
        assert int(rate + 1e-9) <= copies[i] <= int(rate + 1e-9) + 1
    assert copies.keys() <= docs.keys()


def test_every_id_lies_in_one_piece(stages):
    tokenizer, tokens, wanted = Tokenizer.from_file(PATH), Counter(), Counter()
    for r in stages[4].collect():
        wanted.update(tokenizer.encode(r.text, add_special_tokens=False).ids + [2])
    used = defaultdict(int)
    for r in stages[5].collect():
        tokens.update(np.frombuffer(bytes(r.ids), "<u4").tolist())
        used[r.sequence_id] += r.length
    assert tokens == wanted and max(used.values()) <= 4096


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, FOLDER).count() == stages[5].count()
