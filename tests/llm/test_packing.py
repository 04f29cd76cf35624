import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strandweave.llm import packing
from strandweave.tables import Workspace

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "It's the dog's, they'RE 12.5% ok... café café ́x a\x1cb c\xa0d  e 日本語 \U0001f600!", "<|endoftext|> mid<|endoftext|>dle <|startoftext|>",
    "", " \n\t", "a" * 9000, "x y " * 9000, "\x0b\x0c\x85 ß İ Σας ſ ﬁ",
]


def test_encoder_equals_the_tokenizer():
    plain = Tokenizer.from_file(PATH)
    draw = random.Random(1)
    texts = TEXTS + ["".join(draw.choices("ab'sé́ 1.\n\tZ<|> 　", k=40)) for _ in range(500)]
    encoder = packing.Encoder(PATH)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text
    assert encoder.encode(texts) == encoder.encode(texts)


def test_letters_and_signs_of_many_kinds():
    plain, draw = Tokenizer.from_file(PATH), random.Random(3)
    signs = "aZéÉßñÑçùÿŒœĲĳŸſǅ.,!?'\"-_¿¡«»·²½ªº©°§¶\u00ad\u0301İŉǰ\xa0İ1"
    texts = [" ".join("".join(draw.choices(signs, k=draw.randrange(1, 6))) for _ in range(30)) for _ in range(2000)]
    for text, ids in zip(texts, packing.Encoder(PATH).encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_a_tokenizer_of_another_kind_encodes_plainly():
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, encoder = Tokenizer.from_file(path), packing.Encoder(path)
    assert not encoder.by_word
    for text, ids in zip(TEXTS, encoder.encode(TEXTS)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def checked(spark, docs, window=4096, step=16):
    """Every id in exactly one piece, sequences gapless and not too long; returns the share of padding."""
    plain = Tokenizer.from_file(PATH)
    rows = packing.pack(docs, Workspace(spark), PATH, window=window, step=step).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, np.frombuffer(bytes(r.ids), "<u4").tolist(), r.doc_tokens))
        assert len(r.ids) == 4 * r.length > 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    wanted = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        wanted[r.doc_id].append(plain.encode(r.text or "", add_special_tokens=False).ids + [2])
    assert wanted.keys() == pieces.keys()
    for doc_id, copies in wanted.items():
        if len(copies) == 1:
            assert [i for _, ids, _ in sorted(pieces[doc_id]) for i in ids] == copies[0]
            assert {n for *_, n in pieces[doc_id]} == {len(copies[0])}
        else:
            assert sorted(i for _, ids, _ in pieces[doc_id] for i in ids) == sorted(i for c in copies for i in c)
    used = sum(len(ids) for parts in pieces.values() for _, ids, _ in parts)
    return 1 - used / (len(sequences) * window) if sequences else 0


def test_edge_documents(spark, edge_documents):
    checked(spark, edge_documents)
    checked(spark, edge_documents, window=64, step=4)


def test_no_documents(spark, no_documents):
    assert packing.pack(no_documents, Workspace(spark), PATH).collect() == []


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert checked(spark, docs) < 0.02


@pytest.mark.parametrize("lengths", [[60] * 300, [32] * 300, [20, 44] * 100, [1] * 500, [64] * 9 + [128] * 9, [63, 2] * 50])
def test_lengths_that_many_share(spark, lengths):
    docs = spark.createDataFrame([(i, " ".join(["the"] * (n - 1))) for i, n in enumerate(lengths)], "doc_id bigint, text string")
    assert checked(spark, docs, window=64, step=4) < 0.15


def test_counts_take_no_more_than_there_is():
    draw = np.random.default_rng(2)
    for _ in range(8):
        histogram = draw.integers(0, 200, 33) * draw.integers(0, 2, 33)
        used = np.zeros(33, dtype=int)
        for fill in packing.solve(histogram):
            assert sum(k * n for k, n in fill.lengths.items()) == 32
            for k, n in fill.lengths.items():
                used[k] += n * fill.count
        assert (used <= histogram).all()


def test_least_squares():
    draw = np.random.default_rng(4)
    matrix, truth = draw.random((12, 30)), np.maximum(0, draw.normal(size=30))
    x = packing.nonnegative_least_squares(matrix, matrix @ truth)
    assert (x >= 0).all() and np.allclose(matrix @ x, matrix @ truth, atol=1e-6)
    assert zlib.crc32(b"") == 0
