import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pandas as pd

from strandweave.llm import pii
from strandweave.llm.pii import base_spans, find_personal_data
from strandweave.tables import Workspace

PLAIN = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")), ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([ -]?[0-9])+")), ("phone", re.compile(r"\+[0-9][ ().0-9-]+[0-9]")),
]


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else int(d) * 2 - 9 * (int(d) > 4) for i, d in enumerate(reversed(digits))) % 10 == 0


def by_hand(text):
    found = []
    for kind, pattern in PLAIN:
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(p) < 256 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(found)


TEXTS = [
    "a@b.c@d.e a@b@c.d @x.y x@y. .@-.- é a.b+c@d-e.f.g,", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3 1..2.3.4", "4111 1111-1111 1111 x 4111111111111111 4111111111111112",
    "+1 (269) 555-3296 +12 3 +1()() +1 2345678 9012345 678", "+" * 3000 + "1" * 3000 + "@" * 3000 + "." * 3000, "日本 \U0001f600 me@x.org 10.0.0.1",
    "4111 1111 1111 1111 4111 1111 1111 1111", "a" * 30000 + "@" + "b" * 30000 + "." + "c" * 30000,
]


def joined(text):
    return ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{s}:{e}" for k, s, e in base_spans(text))


def test_base_spans_equal_plain_scans():
    draw = random.Random(5)
    samples = TEXTS + ["".join(draw.choices("ab.@+-() 0123456789", k=draw.randrange(60))) for _ in range(3000)]
    for text in samples:
        assert joined(text) == by_hand(text), text


def test_documents(spark, edge_documents):
    docs = edge_documents.unionByName(spark.createDataFrame([(100 + i, t, None, None, None, None, None) for i, t in enumerate(TEXTS)], edge_documents.schema))
    wanted = sorted((str(r.doc_id), by_hand(r.text)) for r in docs.collect())
    got = find_personal_data(docs, Workspace(spark)).collect()
    assert sorted((str(r.doc_id), r.spans) for r in got) == wanted
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == sorted((i, hashlib.sha256(s.encode()).hexdigest()) for i, s in wanted)


def test_no_documents(spark, no_documents):
    assert find_personal_data(no_documents, Workspace(spark)).collect() == []


def test_contexts_of_seeds_find_what_no_pattern_describes(spark):
    draw = random.Random(7)
    words = lambda n: " ".join("".join(draw.choices("abcdefgh", k=4)) for _ in range(n))
    rows = [(i, f"{words(9)} reach me at {words(1)}.{i}@mail.org, {words(9)} of the hill {words(4)}") for i in range(40)]
    rows += [(100 + i, f"{words(9)} of the {words(1)}{i}@x.org {words(3)}") for i in range(4)] + [(110 + i, f"of the {words(1)} of the {words(1)}") for i in range(40)]
    rows += [(200, "Please reach me AT \"member-7714\" or so"), (201, "numbers of the 775533 kind"), (202, "reach me at noon")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    of = {r.doc_id: r.spans for r in find_personal_data(docs, Workspace(spark)).collect()}
    assert of[200] == "context:20:31" and of[201] == of[202] == ""
    assert all(of[i].startswith("email:") and "context" not in of[i] for i in range(40))


def test_copies_of_documents_change_no_span(spark):
    draw = random.Random(7)
    words = lambda n: " ".join("".join(draw.choices("abcdefgh", k=4)) for _ in range(n))
    rows = [(i, f"{words(9)} reach me at {words(1)}.{i}@mail.org") for i in range(40)] + [(200, "reach me at member-7714 or so"), (202, "reach me at noon"), (203, "meet me at noon")]
    docs = spark.createDataFrame(rows + [r for r in rows if r[0] >= 200] * 1000, "doc_id bigint, text string")
    found = {(r.doc_id, r.spans) for r in find_personal_data(docs, Workspace(spark)).collect()}
    once = {(r.doc_id, r.spans) for r in find_personal_data(docs.distinct(), Workspace(spark)).collect()}
    assert found == once and (200, "context:12:23") in found and len(found) == len(rows)


def test_a_pattern_counts_however_many_other_seeds_there_are(spark):
    draw = random.Random(3)
    word = lambda: "".join(draw.choices("abcdefgh", k=6))
    rows = [(i, " ".join(f"{word()} {word()} {word()}.{i}.{k}@mail.org" for k in range(100))) for i in range(100)]
    rows += [(1000 + i, f"badge number was {i}@mail.org") for i in range(3)] + [(2000, "the badge number was member-7714 then")]
    of = {r.doc_id: r.spans for r in find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string"), Workspace(spark)).collect()}
    assert of[2000] == "context:21:32"


def context_spans_by_hand(texts):
    """Every pattern with three seeds, all it shows in all texts at once, scored in three rounds."""
    shows, plain, places = defaultdict(dict), defaultdict(set), []
    for number, text in enumerate(texts):
        words = [(m.start(), m.group()) for m in re.finditer(r"\S+", text)]
        spans = {start: end for _, start, end in base_spans(text)}
        for (_, a), (_, b), (begin, word) in zip(words, words[1:], words[2:], strict=False):
            pattern = (a, b)
            if begin in spans:
                shows[pattern][text[begin:spans[begin]]] = True
            elif len(word) >= 5 and re.search("[0-9@]", word):
                shows[pattern].setdefault(word, False)
                places.append((number, begin, begin + len(word), pattern, word))
            else:
                plain[pattern].add(word)
    supported = {p: seen for p, seen in shows.items() if sum(seen.values()) >= 3}
    kept = {p: seen for p, seen in supported.items() if len(plain[p]) <= 19 * len(seen)}
    seeds = {v for seen in supported.values() for v, seed in seen.items() if seed}
    worth = {}
    for _ in range(3):
        score = {p: sum(1 if v in seeds else worth.get(v, 0) for v in seen) / (len(seen) + len(plain[p])) for p, seen in kept.items()}
        worth = {v: 1 - math.prod(1 - score[p] for p, seen in kept.items() if v in seen) for seen in kept.values() for v in seen if v not in seeds}
    found = defaultdict(set)
    for number, start, end, p, word in places:
        if score.get(p, 0) >= 0.6 and worth.get(word, 0) >= 0.6:
            found[number].add((start, end))
    return found, len(supported) - len(kept)


def test_context_spans_equal_a_scan_of_all_texts_at_once(spark):
    draw = random.Random(11)
    first, second = [f"f{c}" for c in "abcdefgh"], [f"s{c}" for c in "abcdefgh"]
    plain = ["".join(draw.choices("abcdefgh", k=5)) for _ in range(900)]
    ids = [f"no-{draw.randrange(10**6)}" for _ in range(200)]
    shares = {(a, b): draw.choice([(60, 30, 10), (5, 80, 5), (40, 10, 20), (2, 1, 300), (1, 0, 80)]) for a in first for b in second}

    def triple():
        pair = draw.choice(list(shares))
        kind = draw.choices("sip", shares[pair])[0]
        return " ".join((*pair, {"s": f"u{draw.randrange(500)}@x.org", "i": draw.choice(ids), "p": draw.choice(plain)}[kind]))

    texts = [" ".join(triple() for _ in range(20)) for _ in range(1500)]
    wanted, left_out = context_spans_by_hand(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: r.spans for r in find_personal_data(docs, Workspace(spark)).collect()}
    assert left_out > 5 and sum(map(len, wanted.values())) > 500
    for number in range(len(texts)):
        base = joined(texts[number])
        more = ",".join(f"context:{s}:{e}" for s, e in sorted(wanted[number]))
        assert got[number] == ",".join(filter(None, (base, more))), number


def plain_words(texts, patterns, power):
    table = bytearray(pii.PATTERN_BITS)
    for pattern in patterns:
        table[pattern % pii.PATTERN_BITS] = power
    batches = [pd.DataFrame({"text": texts[k:k + 7]}) for k in range(0, len(texts), 7)]
    return [tuple(row) for found in pii._plain(zlib.compress(bytes(table)))(iter(batches)) for row in found.itertuples(index=False)]


def test_plain_words_cost_a_hash_a_word_and_none_a_pair(monkeypatch):
    draw = random.Random(2)
    words = [f"word{'abcdefghijklmnopqrst'[k // 20]}{'abcdefghijklmnopqrst'[k % 20]}" for k in range(200)]
    texts = [" ".join(draw.choices(words, k=300)) for _ in range(30)]
    calls, plain = [], pii.xxhash.xxh64_intdigest
    monkeypatch.setattr(pii.xxhash, "xxh64_intdigest", lambda text: calls.append(text) or plain(text))
    assert plain_words(texts, [], 1) == [] and len(calls) <= 2 * len(words)


def test_plain_words_equal_a_walk_over_each_text(monkeypatch):
    draw = random.Random(4)
    some = ["at", "At,", "(at)", "the", "THE", "..", ",", "\xa0x", "\x85", "\x1c", "\u0130\u03a3.", "\U0001f600", "no", "yes.", "a1", "a@b", "code-1", "x@y.org", "+1", "(269)", "5553296", "10.0.0.1"]
    texts = [None, "", " \t", "at", "at the", "end at the", "noon is", "\n"]
    texts += ["".join(draw.choice(some) + draw.choice([" ", "  ", "\t\n", "\x0b", "\x0c\r"]) for _ in range(draw.randrange(60))) for _ in range(300)]
    bare = lambda word: word.strip(".,;:!?()[]{}<>\"'").lower()
    pairs = [("at", "the"), ("the", "at"), ("", "no"), ("\x85", "at"), ("+1", "(269)"), ("i\u0307\u03c3", "the")]
    patterns = {pii._pattern(*pair): pair for pair in pairs}
    assert len(patterns) == len(pairs)
    wanted = set()
    for text in filter(None, texts):
        spans = [(start, end) for _, start, end in base_spans(text)]
        words = [(m.start(), m.group()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        for (_, a), (_, b), (begin, word) in zip(words, words[1:], words[2:], strict=False):
            pattern = pii._pattern(a, b)
            if pattern not in patterns or any(begin <= start < begin + len(word) for start, _ in spans):
                continue
            alike = len(bare(word)) >= 5 and re.search("[0-9@]", word) and not any(start < begin < end for start, end in spans)
            if not alike:
                wanted.add((pattern, pii._hash(bare(word) or word.lower())))
    assert len(wanted) > 40 and len({pattern for pattern, _ in wanted}) >= 5
    for chunk in (1, 50, 1 << 16):
        monkeypatch.setattr(pii, "CHUNK", chunk, raising=False)
        monkeypatch.setattr(pii, "MEMO", chunk)
        got = plain_words(texts, patterns, pii.UNBOUNDED)
        assert set(got) == wanted and len(got) == len(wanted), chunk
    few = plain_words(texts, patterns, 1)  # a pattern's third word is the last that is said
    assert set(few) <= wanted and all(1 <= sum(p == pattern for p, _ in few) <= 3 for pattern, _ in wanted)


def test_pairs_in_the_place_of_a_pattern_are_not_taken_for_it(spark):
    texts = [f"left{k} right{k} word" for k in range(3000)]
    patterns = [pii._pattern(f"left{k}", f"right{k}") for k in range(0, 3000, 2)]
    low = spark.createDataFrame([(p, 5) for p in patterns], "pattern bigint, most bigint")
    everywhere = zlib.compress(b"\5" * pii.PATTERN_BITS)  # every pair is in the place of a pattern
    found = pd.concat(pii._plain(everywhere, pii._checks(low))(iter([pd.DataFrame({"text": texts})])))
    assert set(patterns) <= set(found["pattern"]) and len(found) <= len(patterns) + 3
    assert len(plain_words(texts, patterns, 5)) >= len(patterns)
