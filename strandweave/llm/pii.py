"""Personal data: four fixed kinds, and more of it by bootstrapped contextual extraction.

The fixed kinds are the seeds.  The two words before a seed make a lexical pattern; a pattern
that stands before several different seeds is looked up in all texts, where each occurrence
shows a seed, an unseen token shaped like an identifier, or a plain word.  Spark scores the
graph of patterns and instances in rounds: a pattern is worth the scores of what it shows over
all that it shows, an unseen instance is worth what its patterns make likely.  Unseen instances
of high score, shown by patterns of high score, become spans too.

Seeds and look-alikes are few and are kept with their patterns for the whole corpus.  Plain words
are many, and are counted by growing parts of the corpus: a pattern is left out as soon as its
plain words prove that seeds and look-alikes are too small a share of what it shows.  A pattern's
hash is made of its two words' hashes, so tasks hash a word once and look patterns up in arrays;
only words that stand after a pattern are taken one by one.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from strandweave.llm.common import SMALL_BATCHES, located, look_up, settings
from strandweave.tables import Workspace

KINDS = ("email", "ip", "card", "phone")
FOUND = "context"
# The patterns of the kinds.  Runs are matched from their first sign only, which
# finds the same places without trying every later one.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_SIGN = re.compile(r"[0-9@]")  # in every word where a span starts, and in every look-alike
_SIGN_BYTES = re.compile(rb"[0-9@]")
_WORD = re.compile(r"[^ \t\n\x0b\x0c\r]+")
_EDGES = ".,;:!?()[]{}<>\"'"
_EDGE_BYTES = _EDGES.encode()

PATTERN_BITS = 1 << 22
CHECK_BITS = 1 << 25
LEAST_SEEDS = 3
# Seeds and look-alikes must be this share at least of the different values that a pattern shows;
# its score cannot be above it.
LEAST_SHARE = 0.05
# Plain words are counted in so many parts of the rows: the first ones, then up to these.
PARTS = 64
STEPS = (1, 8, PARTS)
LEAST_SCORE = 0.6
ROUNDS = 3
LEAST_LENGTH = 5
MEMO = 1 << 18
CHUNK = 1 << 16
HELD = 1 << 18
UNBOUNDED = 16
ORDER = 0x9E3779B97F4A7C15  # odd: tells the first word of a pattern from the second


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind, then start."""
    found = []
    if "@" in text:
        last = 0
        for match in _DOMAIN.finditer(text):
            start = at = match.start()
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                found.append((0, start, match.end()))
                last = match.end()
    if _DIGITS.search(text):
        if "." in text:
            for match in _IP.finditer(text):
                parts = (part.lstrip("0") for part in match.group().split("."))
                if all(len(part) <= 3 and int(part or "0") <= 255 for part in parts):
                    found.append((1, match.start(), match.end()))
        for match in _CARD.finditer(text):
            digits = match.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, match.start(), match.end()))
        if "+" in text:
            for match in _PHONE.finditer(text):
                if 8 <= sum(map(str.isdigit, match.group())) <= 15:
                    found.append((3, match.start(), match.end()))
    return found


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _hash(text: str) -> int:
    return _signed(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")))


def _pattern(before: str, last: str) -> int:
    before, last = (_hash(word.strip(_EDGES).lower()) for word in (before, last))
    return _signed((before * ORDER + last) % (1 << 64))


class _Words(dict):
    """Numbers of the lower-cased words met, which are UTF-8; their hashes in patterns stand in an array by number."""

    def __init__(self):
        self.parts = array("Q")

    def __missing__(self, word: bytes) -> int:
        self.parts.append(xxhash.xxh64_intdigest(word.strip(_EDGE_BYTES)))
        number = self[word] = len(self)
        return number


def _identifiers(word: str, begin: int, spans: list[tuple[int, int]], starts: list[int]) -> tuple[list[tuple[int, int]], tuple[int, int] | None]:
    """The spans that start in a word, or else the place of the look-alike it holds; a plain word has neither."""
    first, after = bisect_left(starts, begin), bisect_left(starts, begin + len(word))
    if first < after:
        return spans[first:after], None
    inside = word.strip(_EDGES)
    if len(inside) < LEAST_LENGTH or not _SIGN.search(inside) or (first and spans[first - 1][1] > begin):
        return [], None
    begin += word.index(inside)
    return [], (begin, begin + len(inside))


def contexts(text: str, found: list[tuple[int, int, int]]) -> list[int]:
    """Pattern, instance, start and end of every seed (-1, -1) and look-alike that has two words before it."""
    if not _SIGN.search(text):
        return []
    words = [(m.start(), m.group()) for m in _WORD.finditer(text)]
    spans = sorted((start, end) for _, start, end in found)
    starts = [start for start, _ in spans]
    rows = []
    for at in range(2, len(words)):
        begin, word = words[at]
        if not _SIGN.search(word):
            continue
        known, alike = _identifiers(word, begin, spans, starts)
        if known or alike:
            pattern = _pattern(words[at - 2][1], words[at - 1][1])
            for start, end in known:
                rows += (pattern, _hash(text[start:end].lower()), -1, -1)
            if alike:
                rows += (pattern, _hash(text[slice(*alike)].lower()), *alike)
    return rows


def _extract(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        text = text or ""
        spans = base_spans(text)
        counts = Counter(kind for kind, _, _ in spans)
        joined = ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)
        rows.append((joined, *(counts[k] for k in range(4)), contexts(text, spans)))
    return pd.DataFrame(rows, columns=["spans", *(f"n_{kind}" for kind in KINDS), "contexts"])


def _chunks(texts: pd.Series) -> Iterator[tuple[list[str], list[list[bytes]]]]:
    """Texts that are not empty with their words in lower case, several at a time.

    Bytes are split at the blanks of _WORD, and no blank or edge has or lends a case, so the words are
    those that _WORD finds, each in lower case.
    """
    some, words, count = [], [], 0
    for text in texts:
        if text:
            some.append(text)
            words.append(text.lower().encode("utf-8", "surrogatepass").split())
            count += len(words[-1])
        if count > CHUNK:
            yield some, words
            some, words, count = [], [], 0
    if count:
        yield some, words


def _shown(texts: list[str], words: list[list[bytes]], known: _Words, table: np.ndarray, checks: np.ndarray | None) -> Iterator[tuple[int, int]]:
    """(pattern, word) of the plain words after patterns of the table, each once."""
    sizes = np.array([len(w) for w in words])
    firsts = np.cumsum(sizes) - sizes
    numbers = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), dtype=np.int64, count=sizes.sum())
    parts = np.array(known.parts)[numbers]
    patterns = parts[:-2] * np.uint64(ORDER) + parts[1:-1]  # of the words from the third on
    at = np.flatnonzero(table[patterns % np.uint64(PATTERN_BITS)]) + 2
    if checks is not None:
        bits = (patterns[at - 2] >> np.uint64(32)) % np.uint64(CHECK_BITS)
        at = at[checks[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8) & 1 == 1]
    of = np.searchsorted(firsts, at, "right") - 1
    inside = at - firsts[of] >= 2  # a text's first two words have no pattern
    at, of = at[inside], of[inside]
    place = at - firsts[of]
    _, some, which = np.unique(numbers[at], return_index=True, return_inverse=True)
    different = [words[of[k]][place[k]] for k in some]
    values = np.array([xxhash.xxh64_intdigest(word.strip(_EDGE_BYTES) or word) for word in different], dtype=np.uint64)[which]
    signs = np.array([_SIGN_BYTES.search(word) is not None for word in different], dtype=bool)[which]
    plain = ~signs
    last = None
    for k in np.flatnonzero(signs):
        if last != of[k]:
            last = of[k]
            spans = sorted((start, end) for _, start, end in base_spans(texts[last]))
            starts = [start for start, _ in spans]
            places = [(m.start(), m.group()) for m in _WORD.finditer(texts[last])]
        begin, word = places[place[k]]
        plain[k] = not any(_identifiers(word, begin, spans, starts))
    found = pd.DataFrame({"pattern": patterns[at - 2][plain].view(np.int64), "word": values[plain].view(np.int64)}).drop_duplicates()
    return zip(found["pattern"].tolist(), found["word"].tolist(), strict=True)


def _plain(packed: bytes, packed_checks: bytes | None = None):
    """(pattern, word) of the plain words after the patterns that the table holds and, if given, the second filter.

    The table gives a pattern's limit as a power of two.  A task says a word once, and of a pattern
    no more than one word above its limit, which is all it takes to leave the pattern out.
    """

    def show(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.frombuffer(zlib.decompress(packed), dtype=np.uint8)
        checks = np.frombuffer(zlib.decompress(packed_checks), dtype=np.uint8) if packed_checks else None
        said: dict[int, set[int]] = {}
        held = 0
        full: set[int] = set()  # each has said more than its limit
        known = _Words()
        for batch in batches:
            rows = []
            for texts, words in _chunks(batch["text"]):
                if len(known) > MEMO:
                    known = _Words()
                for pattern, value in _shown(texts, words, known, table, checks):
                    if pattern in full:
                        continue
                    mine = said.setdefault(pattern, set())
                    if value in mine:
                        continue
                    mine.add(value)
                    rows.append((pattern, value))
                    held += 1
                    power = table[pattern % PATTERN_BITS]
                    if power < UNBOUNDED and len(mine) > 1 << int(power):
                        full.add(pattern)
                        held -= len(said.pop(pattern))
                    if held > HELD:  # what was said may be said again: words are counted once
                        said.clear()
                        held = 0
            yield pd.DataFrame(rows, columns=["pattern", "word"]).astype("int64")

    return show


def _table(patterns: DataFrame) -> bytes:
    """The patterns' limits by their hashes, of fixed size whatever their number: the power of two not below a limit."""
    power = F.least(F.lit(UNBOUNDED), F.greatest(F.lit(1), F.ceil(F.log2(F.greatest(F.lit(1), "most"))))).cast("int").alias("power")
    place = (F.pmod("pattern", F.lit(PATTERN_BITS)) + 1).alias("place")  # pieces and places count from 1
    pieces = (
        patterns.select(power, place).groupBy("power", F.bitmap_bucket_number("place").alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect()
    )
    table = np.zeros(PATTERN_BITS, dtype=np.uint8)
    for piece in sorted(pieces, key=lambda p: p.power):  # of patterns in one place the largest limit holds
        bits = np.unpackbits(np.frombuffer(piece.bits, dtype=np.uint8), bitorder="little")
        part = table[(piece.piece - 1) * len(bits):piece.piece * len(bits)]
        part[bits == 1] = piece.power
    return zlib.compress(table.tobytes(), 1)


def _checks(patterns: DataFrame) -> bytes:
    """A bit per place of the patterns' upper halves, of fixed size: few other pairs pass it and the table, which meets the lower halves."""
    place = (F.pmod(F.shiftrightunsigned("pattern", 32), F.lit(CHECK_BITS)) + 1).alias("place")
    pieces = (
        patterns.select(place).groupBy(F.bitmap_bucket_number("place").alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect()
    )
    checks = np.zeros(CHECK_BITS // 8, dtype=np.uint8)
    for piece in pieces:
        bits = np.frombuffer(piece.bits, dtype=np.uint8)
        checks[(piece.piece - 1) * len(bits):piece.piece * len(bits)] = bits
    return zlib.compress(checks.tobytes(), 1)


def _plain_words(source: DataFrame, patterns: DataFrame, workspace: Workspace) -> DataFrame:
    """(pattern, rest): the number of different plain words after each pattern where it is at most ``most``; other patterns have no row.

    A pattern that goes beyond in a part of the corpus is not looked up in the next, larger one.  One that
    stays has few words in the parts before, so the words said grow with the seeds and look-alikes.
    """
    part = F.pmod(F.xxhash64("file", "row"), F.lit(PARTS))
    said, low, alive = [], 0, patterns
    for high in STEPS:
        texts = source.where((part >= low) & (part < high)).select("text")
        with settings(source.sparkSession, SMALL_BATCHES):
            words = workspace.write(texts.mapInPandas(_plain(_table(alive), _checks(alive)), "pattern bigint, word bigint"), "words")
        said.append(words)
        counted = reduce(DataFrame.unionByName, said).groupBy("pattern").agg(F.countDistinct("word").alias("rest"))
        left = alive.select("pattern", "most").join(counted, "pattern", "left")  # the table lets others pass, they have no row here
        left = left.select("pattern", "most", F.coalesce("rest", F.lit(0).cast("bigint")).alias("rest")).where("rest <= most")
        saved = workspace.save(left, "alive")
        alive, low = saved.df, high
        if not saved.rows:
            break
    return alive.select("pattern", "rest")


def _scores(edges: DataFrame, rest: DataFrame, workspace: Workspace, rounds: int) -> tuple[DataFrame, DataFrame]:
    """(pattern, score) and (instance, worth) of unseen instances, after some rounds over the graph of the patterns in ``rest``."""
    is_seed = edges.groupBy("instance").agg(F.max("seed").alias("seed"))
    edges = edges.select("pattern", "instance").join(rest.select("pattern"), "pattern", "left_semi")
    edges = look_up(edges, is_seed, "instance", {"seed": "seed"}, "pattern", workspace)
    edges = workspace.write(look_up(edges, rest, "pattern", {"rest": "rest"}, "instance", workspace), "graph")
    worth = F.lit(0.0)
    scored = edges
    for number in range(rounds):
        value = F.when(F.col("seed"), 1.0).otherwise(worth)
        patterns = scored.groupBy("pattern").agg(
            (F.sum(value) / (F.count(F.lit(1)) + F.first("rest"))).alias("score"), F.sum(F.col("seed").cast("int")).alias("seeds"))
        patterns = patterns.select("pattern", F.when(F.col("seeds") >= LEAST_SEEDS, F.col("score")).otherwise(0.0).alias("score"))
        patterns = workspace.write(patterns, "patterns")
        shares = look_up(edges.where("not seed"), patterns, "pattern", {"score": "score"}, "instance", workspace)
        # 1 - product of (1 - score): several patterns of middling score add up.
        doubt = F.exp(F.sum(F.log(F.greatest(F.lit(1e-12), 1 - F.col("score")))))
        instances = workspace.write(shares.groupBy("instance").agg((1 - doubt).alias("worth")), "instances")
        if number + 1 < rounds:
            scored = look_up(edges, instances, "instance", {"worth": "worth"}, "pattern", workspace)
            worth = F.coalesce("worth", F.lit(0.0))
    return patterns, instances


def find_personal_data(docs: DataFrame, workspace: Workspace, least_seeds: int = LEAST_SEEDS, least_score: float = LEAST_SCORE, rounds: int = ROUNDS,
                       least_share: float = LEAST_SHARE) -> DataFrame:
    """One row per document: doc_id, counts per kind, base_sha256, spans (kind:start:end, code points).

    A null text is empty.  Repeated rows give repeated results, and their seeds count once, as
    support counts different values.  An empty table gives no rows.  Only id and text are read.
    """
    source = located(docs, workspace).select("file", "row", F.col("doc.doc_id").alias("doc_id"), F.col("doc.text").alias("text"))
    extract = F.pandas_udf(_extract, ", ".join(["spans string", *(f"n_{kind} bigint" for kind in KINDS), "contexts array<bigint>"]))
    with settings(docs.sparkSession, SMALL_BATCHES):
        base = workspace.write(source.select("file", "row", "doc_id", extract("text").alias("x")).select("file", "row", "doc_id", "x.*"), "base")

    numbers = F.filter(F.sequence(F.lit(0), F.size("contexts")), lambda k: 4 * k < F.size("contexts"))
    names = ("pattern", "instance", "start", "end")
    shown = base.where(F.size("contexts") > 0).select("file", "row", F.explode(F.transform(
        numbers, lambda k: F.struct(*[F.get("contexts", 4 * k + place).alias(name) for place, name in enumerate(names)]))).alias("s"))
    shown = shown.select("file", "row", "s.pattern", "s.instance", F.col("s.start").cast("int").alias("start"), F.col("s.end").cast("int").alias("end"),
                         (F.col("s.start") < 0).alias("seed"))
    supported = shown.where("seed").groupBy("pattern").agg(F.countDistinct("instance").alias("seeds")).where(F.col("seeds") >= least_seeds)
    supported = workspace.save(supported.select("pattern"), "supported")
    output = [F.col(f"n_{kind}") for kind in KINDS]
    digest = F.sha2("spans", 256).alias("base_sha256")
    if not supported.rows:
        return base.select("doc_id", *output, digest, "spans")
    exact = workspace.write(shown.join(supported.df, "pattern", "left_semi"), "exact")
    edges = workspace.write(exact.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "edges")
    most = F.floor(F.count(F.lit(1)) * ((1 - least_share) / least_share) + 1e-6).alias("most")
    patterns = workspace.write(edges.groupBy("pattern").agg(most), "patterns")
    rest = _plain_words(source, patterns, workspace)
    scores, worth = _scores(edges, rest, workspace, rounds)
    good = look_up(exact.where("not seed"), scores.where(F.col("score") >= least_score), "pattern", {"score": "score"}, "row", workspace)
    good = look_up(good.where("score is not null"), worth.where(F.col("worth") >= least_score), "instance", {"worth": "worth"}, "row", workspace)
    span = F.struct("start", "end")
    found = good.where("worth is not null").groupBy("file", "row").agg(F.array_sort(F.collect_set(span)).alias("more"))
    joined = F.array_join(F.transform("more", lambda s: F.concat_ws(":", F.lit(FOUND), s["start"], s["end"])), ",")
    both = base.join(found, ["file", "row"], "left")
    every = F.array_join(F.filter(F.array("spans", joined), lambda s: F.coalesce(s, F.lit("")) != ""), ",")
    return both.select("doc_id", *output, digest, every.alias("spans"))
