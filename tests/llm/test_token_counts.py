import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings as limits, strategies as st
from tokenizers import Tokenizer

from strandweave.llm import token_counts
from strandweave.llm.common import read_table
from strandweave.llm.queries import op13_token_counts

NAMES = ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model")
TEXTS = [
    "It's the dog's, they'RE 12.5% ok... café café ́x a\x1cb c\xa0d  e 日本語 \U0001f600!", "<|endoftext|> mid<|endoftext|>dle <|startoftext|>",
    "<s> </s> a<|endoftext|>b", "", " ", " \n\t", "a" * 9000, "x y " * 9000, "\x0b\x0c\x85 ß İ Σας ſ ﬁ x᠎y", "one  two\n\nthree ▁ four▁five",
    "The cat sat on the mat and looked at 3 dogs. " * 40, "word\r\nword\tword \x1f word",
]


def by_library(path):
    if path.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    tokenizer = Tokenizer.from_file(path)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", NAMES)
def test_counts_equal_the_library(name, monkeypatch):
    monkeypatch.setattr(token_counts, "BATCH_CHARS", 100)
    path = public_tokenizers.path(name)
    wanted = by_library(path)
    counter = token_counts.LengthCounter(path)
    assert counter.boundary is not None
    assert counter.count(TEXTS).tolist() == [wanted(t) for t in TEXTS]
    for text in TEXTS:  # as if each were long
        pieces = list(token_counts.split_long(text, counter.boundary, counter.keep, 7))
        assert sum(map(wanted, pieces)) == wanted(text), text


@pytest.mark.parametrize("name", NAMES)
def test_any_text_may_be_split(name):
    path = public_tokenizers.path(name)
    wanted, counter = by_library(path), token_counts.LengthCounter(path)
    letters = st.sampled_from(list("aZ9 \n\t'.,-é́ΣßİﬁＡ日▁\xa0 \x1c᠎") + ["the ", " s ", "'s ", "<|endoftext|>", "</s>"])

    @limits(max_examples=150, deadline=None)
    @given(st.lists(letters, max_size=60).map("".join), st.integers(0, 20))
    def check(text, most):
        assert counter.count([text]).tolist() == [wanted(text)]
        assert sum(map(wanted, token_counts.split_long(text, counter.boundary, counter.keep, most))) == wanted(text)

    check()


def test_batches_are_balanced_and_whole():
    pieces = [(k, "x" * n) for k, n in enumerate((1, 500, 3, 3, 3, 1000, 0, 2))]
    batches = list(token_counts.balanced(pieces, 500))
    assert [p for batch in batches for p in batch] == pieces
    assert all(sum(len(t) for _, t in batch[:-1]) < 500 for batch in batches)


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO_WORDS", 50)
    path = public_tokenizers.path(NAMES[0])
    counter, wanted = token_counts.LengthCounter(path), by_library(path)
    for k in range(20):
        texts = [f"word{k} word{k + j} plain" for j in range(30)]
        assert counter.count(texts).tolist() == [wanted(t) for t in texts]
        assert len(counter.young) <= 50 + 31 and len(counter.old) <= 50 + 31


def test_query_equals_the_library(spark):
    folder = "/root/testdata/sf0.01"
    wanted = by_library(public_tokenizers.path(NAMES[0]))
    rows = {r.doc_id: r for r in op13_token_counts(spark, folder).collect()}
    docs = read_table(spark, folder, "documents").collect()
    assert len(rows) == len(docs)
    for d in docs:
        text = d.text or ""
        n = wanted(text)
        assert tuple(rows[d.doc_id]) == (d.doc_id, len(text.encode()), n, n > 2048)


def test_edge_documents(spark, edge_documents, no_documents):
    path = public_tokenizers.path(NAMES[0])
    wanted = by_library(path)
    found = token_counts.count_tokens(edge_documents, path)
    texts = [(r.doc_id, r.text or "") for r in edge_documents.collect()]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(
        str((i, len(t.encode()), wanted(t), wanted(t) > 2048)) for i, t in texts)
    assert token_counts.count_tokens(no_documents, path).collect() == []
