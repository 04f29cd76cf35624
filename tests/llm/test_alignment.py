import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings as limits, strategies as st
from tokenizers import Tokenizer

from strandweave.llm import alignment
from strandweave.llm.common import read_table
from strandweave.llm.queries import op11_alignment
from strandweave.tables import Workspace

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "the cat sat on the mat", " leading", "trailing ", "two  blanks\n\nlines\n", "naïve café 日本語 \U0001f600", "mark▁ed", "<s> </s> <|endoftext|>",
    "\ttab\x00zero\x1cfs\xa0nb᠎ x", "ﬁ Ａ é", "x" * 300, "\U0001f600 \U0001f600", " ", "\n", "a b" * 50, "it's they're 12,345.67",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), alignment.Vocabularies(A, B)


def groups_by_hand(text, libraries):
    """The groups of a whole text, token by token; none where the bytes differ."""
    a, b, v = libraries
    if not text:
        return []
    left = [(i, v.a_bytes[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, v.b_bytes[i]) for i in b.encode(text)]
    plain = (" " + text).encode()
    if b"".join(x for _, x in left) != plain or b"".join(x for _, x in right) != plain:
        return []
    groups, i, j, at, to = [([], [])], 0, 0, 0, 0
    while i < len(left) or j < len(right):
        if at <= to and i < len(left):
            groups[-1][0].append(left[i][0])
            at += len(left[i][1])
            i += 1
        else:
            groups[-1][1].append(right[j][0])
            to += len(right[j][1])
            j += 1
        if at == to:
            groups.append(([], []))
    return groups[:-1]


def by_hand(rows, libraries):
    found = [(i, groups_by_hand(text, libraries)) for i, text in rows]
    count = Counter()
    for _, groups in found:
        count.update({(x, y) for xs, ys in groups for x in xs for y in ys})
    best = {}
    for (x, _), n in count.items():
        best[x] = max(n, best.get(x, 0))
    for i, groups in found:
        links = [(x, y) for xs, ys in groups for x in xs for y in ys]
        shown = ";".join(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}" for xs, ys in groups)
        yield (i, sum(len(xs) for xs, _ in groups), sum(len(ys) for _, ys in groups), len(groups), len(links),
               sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(shown.encode()).hexdigest() if groups else "")


def test_token_bytes_are_read_right(libraries):
    _, b, v = libraries
    assert len(set(v.a_bytes)) == len(v.a_bytes) - 0 and v.b_bytes[b.piece_to_id("<0x0A>")] == b"\n"
    some = [(i, j) for i, j in enumerate(v.same.tolist()) if j >= 0]
    assert len(some) > 10_000 and all(v.a_bytes[i] == v.b_bytes[j] for i, j in some)
    assert v.parts


def test_units_equal_whole_texts(libraries):
    v = libraries[2]
    letters = st.sampled_from(list("aZ9 \n\t'.,-éΣßİﬁＡ日▁\xa0\x1c᠎\x85\x00") + ["the ", " of", "'s ", " <|endoftext|>", "</s>", "  "])

    @limits(max_examples=300, deadline=None)
    @given(st.lists(letters, max_size=40).map("".join))
    def check(text):
        wanted = groups_by_hand(text, libraries)
        units = alignment.align(v, v.units(text)) if text else []
        if None in units:
            assert wanted == []
            return
        shown = ";".join(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}" for xs, ys in wanted)
        assert ";".join(u.text for u in units) == shown
        links = Counter(x * v.width + y for xs, ys in wanted for x in xs for y in ys)
        assert Counter(p for u in units for p in np.frombuffer(u.pairs, v.pair).tolist()) == links

    check()


def test_counts_over_chunks_equal_brute_force(spark, libraries, monkeypatch):
    rows = [(k, text) for k, text in enumerate(TEXTS * 2 + ["", None, "the the the cat", "ab" * 40, "cat ab"])] + [(0, "the cat"), (None, "the mat"), (3, "the cat")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    wanted = sorted(map(str, by_hand(rows, libraries)))
    assert sorted(str(tuple(r)) for r in alignment.align_documents(docs, Workspace(spark), A, B).collect()) == wanted


def test_chunks_share_what_they_count(libraries):
    """Chunks of one document each, added up by hand, give the numbers of one chunk of all."""
    texts = TEXTS[:8]
    aligner, one, many = alignment.Aligner(A, B), np.zeros(60_000, dtype=np.int64), np.zeros(60_000, dtype=np.int64)
    together, (pairs, docs) = alignment.chunk_rows(aligner, list(range(8)), texts, one)
    apart, count = [], Counter()
    for k, text in enumerate(texts):
        rows, (p, d) = alignment.chunk_rows(aligner, [k], [text], many)
        apart += rows
        count.update(dict(zip(np.frombuffer(p, "<i8").tolist(), np.frombuffer(d, "<i8").tolist())))
    assert together == apart and (one == many).all()
    assert count == dict(zip(np.frombuffer(pairs, "<i8").tolist(), np.frombuffer(docs, "<i8").tolist()))


def test_tables_of_units_are_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "MEMO_UNITS", 20)
    aligner, vector = alignment.Aligner(A, B), np.zeros(60_000, dtype=np.int64)
    fresh = alignment.Aligner(A, B)
    for k in range(10):
        texts = [f"word{k} word{k + j} plain" for j in range(30)]
        found = alignment.chunk_rows(aligner, list(range(30)), texts, vector)
        assert found == alignment.chunk_rows(fresh, list(range(30)), texts, vector)
        assert len(aligner.young) <= 20 + 32 + 30


def test_query_equals_brute_force(spark, libraries):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in read_table(spark, folder, "documents").collect()]
    assert sorted(tuple(r) for r in op11_alignment(spark, folder).collect()) == sorted(by_hand(rows, libraries))


def test_edge_documents(spark, edge_documents, no_documents, libraries):
    rows = [(r.doc_id, r.text) for r in edge_documents.collect()]
    found = alignment.align_documents(edge_documents, Workspace(spark), A, B)
    assert sorted(str(tuple(r)) for r in found.collect()) == sorted(map(str, by_hand(rows, libraries)))
    assert alignment.align_documents(no_documents, Workspace(spark), A, B).collect() == []
