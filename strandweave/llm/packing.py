"""Packing token sequences by non-negative least squares over a histogram of lengths.

Documents become token ids, cut at whole windows; a full window is a sequence of its own, and
what remains of each document is shorter than a window.  Those lengths, in steps of ``STEP``,
make a histogram.  All shallow combinations of lengths that fill a window are enumerated, and
the repeat counts that reproduce the histogram best are solved for, rounded down, and given
back where they ask for more than there is.  The documents left over are packed greedily, one
after another, and cut where a window ends.

Only the histogram (one number per length) reaches the driver.  Which document takes which
place follows from its rank among the documents of its length, and ranks are sums of counts
per task, so a length that a third of all documents share is spread like any other.
"""

from __future__ import annotations

import gc
import json
import re
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from strandweave.llm.common import SMALL_BATCHES, settings
from strandweave.tables import Workspace

WINDOW = 4096
STEP = 16
MOST_PIECES = 6
ROUNDS = 3
END_ID = 2
CACHE_WORDS = 400_000
# Letters below the combining marks, whose lower case is one letter each, then signs.
_LETTERS_AND_SIGNS = re.compile("((?:(?![\u0130\u0250-\U0010ffff])[^\\W\\d_])+)([!-/:-@\\[-^`{-~\u00a1-\u00a9\u00ab\u00ac\u00ae-\u00b1\u00b6-\u00b8\u00bb\u00bf]*)")
GROUP_CHARS = 1 << 22
BULK = 256


# The steps of a tokenizer whose words can be encoded apart.
_NORMAL = ["NFC", "Replace", "Lowercase"]
_PARTING = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _parts_words(config: dict) -> bool:
    steps = (config.get("normalizer") or {}).get("normalizers", [])
    cuts = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        [step["type"] for step in steps] == _NORMAL and len(cuts) == 2
        and cuts[0].get("pattern") == {"Regex": _PARTING} and cuts[0].get("invert") is True
        and cuts[1]["type"] == "ByteLevel" and not cuts[1].get("add_prefix_space") and not cuts[1].get("use_regex")
    )


assert sys.byteorder == "little" and array("I").itemsize == 4


class Encoder:
    """Token ids of texts, word by word: the tokenizer never joins signs across a blank.

    Words met before are looked up in two generations of bounded tables.  A new word that is
    letters and then signs has the ids of its lower-case letters and of its signs, which the
    tokenizer's model gives without the steps before it.  All this holds for tokenizers that
    lower the case, drop blanks and part letters from signs; others encode each text plainly.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = _parts_words(json.loads(self.tokenizer.to_str()))
        self.model = self.tokenizer.model
        self.sign = {}
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        for code in range(0x21, 0x250):
            self.sign[code] = level.pre_tokenize_str(chr(code))[0][0]
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _missing(self, words: set[str]) -> list[str]:
        """Of ``words`` those in neither table; known ones of the old table move to the young."""
        missing = []
        for word in words.difference(self.young):
            known = self.old.get(word)
            if known is None:
                missing.append(word)
            else:
                self.young[word] = known
        return missing

    def _learn_parts(self, words: list[str]) -> None:
        """Encode ``words``, by their parts where they have some."""
        parted, letters, signs, whole = [], [], [], []
        match = _LETTERS_AND_SIGNS.fullmatch
        for word in words:
            found = match(word)
            if found and (first := found[1]).isalpha():
                parted.append(word)
                letters.append(first.lower())
                signs.append(found[2])
            else:
                whole.append(word)
        tokenize, sign, young = self.model.tokenize, self.sign, self.young
        for part in self._missing({*letters, *signs}):
            tokens = tokenize(part if part.isascii() else part.translate(sign))
            young[part] = array("I", [token.id for token in tokens]).tobytes()
        self._learn(sorted(whole))
        for word, first, last in zip(parted, letters, signs):
            young[word] = young[first] + young[last]

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), BULK):
            part = words[at:at + BULK]
            encoded = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            places = encoded.word_ids
            if None in places:  # a word holds a special token
                for word in part:
                    self.young[word] = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
                continue
            data = np.array(encoded.ids, dtype="<u4").tobytes()
            cuts = (4 * np.searchsorted(np.array(places, dtype=np.int64), np.arange(len(part) + 1))).tolist()
            for word, begin, end in zip(part, cuts, cuts[1:]):
                self.young[word] = data[begin:end]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each, little-endian."""
        if not self.by_word:
            encoded = self.tokenizer.encode_batch(texts, add_special_tokens=False)
            return [np.array(e.ids, dtype="<u4").tobytes() for e in encoded]
        split = [text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for text in texts]
        self._learn_parts(self._missing(set().union(*split)))
        ids = [b"".join(map(self.young.__getitem__, words)) for words in split]
        if len(self.young) > CACHE_WORDS:
            self.old, self.young = self.young, {"": b""}
        return ids


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _groups(texts: pd.Series) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def windows_of(text: Column, tokenizer: str, end_id: int = END_ID, window: int = WINDOW) -> Column:
    """The ids of each text and ``end_id`` as an array of whole windows and the rest, in bytes."""

    @F.pandas_udf("array<binary>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder, end, width = _encoder(tokenizer), end_id.to_bytes(4, "little"), 4 * window
        for batch in batches:
            found = []
            for group in _groups(batch):
                gc.disable()  # a search for cycles would go through all known words, and none has one
                for ids in encoder.encode(group):
                    ids += end
                    found.append([ids[k:k + width] for k in range(0, len(ids), width)])
                gc.enable()
            yield pd.Series(found, dtype=object)

    return cut.asNondeterministic()(text)  # never to be computed twice for its two uses


def combinations(units: int, most: int = MOST_PIECES) -> list[dict[int, int]]:
    """Lengths (1 to ``units``) and their repeats that add up to ``units`` with at most ``most`` pieces.

    Two different lengths, each as often as it fits, or three different ones.
    """
    found = [{units // n: n} for n in range(1, most + 1) if units % n == 0]
    for a in range(1, units):
        for i in range(1, most):
            for j in range(1, most - i + 1):
                b, odd = divmod(units - i * a, j)
                if not odd and b > a:
                    found.append({a: i, b: j})
    if most >= 3:
        found += [{a: 1, b: 1, units - a - b: 1} for a in range(1, units // 3 + 1) for b in range(a + 1, (units - a + 1) // 2) if units - a - b > b]
    return found


def nonnegative_least_squares(matrix: np.ndarray, wanted: np.ndarray, steps: int = 400) -> np.ndarray:
    """x >= 0 with the least |matrix x - wanted|, by active sets."""
    x = np.zeros(matrix.shape[1])
    active: list[int] = []
    tolerance = 1e-9 * max(1.0, float(np.abs(matrix.T @ wanted).max(initial=0.0)))
    for _ in range(steps):
        slope = matrix.T @ (wanted - matrix @ x)
        slope[active] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= tolerance:
            break
        active.append(best)
        while True:
            part = matrix[:, active]
            solved = np.linalg.lstsq(part, wanted, rcond=None)[0]
            if (solved > 0).all():
                break
            now = x[active]
            low = solved <= 0
            share = float(np.min(now[low] / np.maximum(now[low] - solved[low], 1e-300)))
            moved = now + share * (solved - now)
            x[:] = 0
            keep = [(k, v) for k, v, down in zip(active, moved, low) if v > 1e-9 and not (down and v <= 1e-9)]
            active = [k for k, _ in keep]
            x[active] = [v for _, v in keep]
            if not active:
                break
        x[:] = 0
        if active:
            x[active] = solved
    return x


@dataclass(frozen=True)
class Fill:
    """A combination of lengths and how many windows it fills."""

    lengths: dict[int, int]
    count: int


def solve(histogram: np.ndarray, most: int = MOST_PIECES, rounds: int = ROUNDS) -> list[Fill]:
    """Combinations and counts that take no more documents of any length than there are.

    ``histogram[k]`` counts lengths of k units; what rounding leaves is solved for again.
    """
    units = len(histogram) - 1
    choices = combinations(units, most)
    matrix = np.zeros((units + 1, len(choices)))
    for k, lengths in enumerate(choices):
        for length, repeats in lengths.items():
            matrix[length, k] = repeats
    left = histogram.astype(np.int64).copy()
    counts = np.zeros(len(choices), dtype=np.int64)
    weight = np.arange(units + 1)[:, None] / units  # a unit of text counts the same in any length
    for _ in range(rounds):
        usable = np.flatnonzero(((matrix > 0) <= (left > 0)[:, None]).all(axis=0))
        if not len(usable):
            break
        some = matrix[:, usable]
        x = np.floor(nonnegative_least_squares(some * weight, left * weight[:, 0]) + 1e-6).astype(np.int64)
        over = (some @ x).astype(np.int64) - left
        for length in np.flatnonzero(over > 0)[::-1]:
            for k in np.argsort(-x, kind="stable"):
                excess = int((some[length] @ x) - left[length])
                if excess <= 0:
                    break
                if some[length, k] and x[k]:
                    x[k] -= min(x[k], -(-excess // int(some[length, k])))
        if not x.any():
            break
        counts[usable] += x
        left -= (some @ x).astype(np.int64)
    return [Fill(choices[k], int(counts[k])) for k in np.flatnonzero(counts)]


def _places(fills: list[Fill]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, repeats, first slot) for every length of every fill."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for fill in fills:
        slot = 0
        for length, repeats in sorted(fill.lengths.items(), reverse=True):
            first = taken.get(length, 0)
            taken[length] = first + repeats * fill.count
            rows.append((length, first, taken[length], sequence, repeats, slot))
            slot += repeats
        sequence += fill.count
    return rows


def pack(docs: DataFrame, workspace: Workspace, tokenizer: str, end_id: int = END_ID, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """The packed sequences, a row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` are the piece's token ids, four bytes each, little-endian.  A null text is an empty
    one and consists of ``end_id``.  Rows that repeat are packed as often.  An empty table gives
    no rows.  Only id and text are read.
    """
    spark = docs.sparkSession
    cut = docs.select("doc_id", windows_of(F.col("text"), tokenizer, end_id, window).alias("parts"))
    total = F.aggregate("parts", F.lit(0).cast("long"), lambda n, part: n + F.octet_length(part))
    path = workspace.folder("windows")
    numbered = cut.select("doc_id", (total / 4).cast("long").alias("doc_tokens"), F.posexplode("parts").alias("k", "ids")).select(
        F.monotonically_increasing_id().alias("piece"), "doc_id", "doc_tokens", (F.col("k").cast("long") * window).alias("start"),
        (F.octet_length("ids") / 4).cast("long").alias("length"), "ids")
    with settings(spark, SMALL_BATCHES):
        numbered.write.option("compression", "zstd").parquet(path)
    pieces = spark.read.parquet(path)

    short = pieces.where(F.col("length") < window).select("piece", "length", F.shiftright("piece", 33).alias("task"), F.ceil(F.col("length") / step).cast("int").alias("units"))
    within = Window.partitionBy("task", "units").orderBy(F.xxhash64("piece"), "piece")  # copies that follow each other part
    ranked = workspace.write(short.withColumn("place", F.row_number().over(within) - 1), "ranked")
    counts = workspace.write(ranked.groupBy("task", "units").agg(F.count(F.lit(1)).alias("n")), "counts")
    # One row per length: the histogram has window / step numbers, whatever the corpus.
    sums = {row.units: row.n for row in counts.groupBy("units").agg(F.sum("n").alias("n")).collect()}
    fills = solve(np.array([sums.get(k, 0) for k in range(window // step + 1)]))
    main = sum(fill.count for fill in fills)

    earlier = Window.partitionBy("units").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    offsets = counts.select("task", "units", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranks = ranked.join(offsets, ["task", "units"]).select("piece", "task", "length", "units", (F.col("before") + F.col("place")).alias("rank"))
    table = spark.createDataFrame(_places(fills), "units int, first bigint, end bigint, sequence bigint, repeats int, slot int")
    taken = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    # Rows of the plan are at most the lengths of all fills: bounded by the number of lengths.
    placed = workspace.write(ranks.join(F.broadcast(table.withColumnRenamed("units", "of")), (F.col("units") == F.col("of")) & taken, "left"), "placed")

    turn = F.col("rank") - F.col("first")
    filled = placed.where("sequence is not null").select(
        "piece", "length", (F.col("sequence") + F.floor(turn / F.col("repeats"))).alias("sequence_id"), (F.col("slot") + turn % F.col("repeats")).alias("slot"))
    ahead = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    whole = filled.select(
        "piece", F.lit(0).cast("long").alias("skip"), "length", "sequence_id", F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset"))

    rest = placed.where("sequence is null").select("piece", "task", "length")
    by_task = rest.groupBy("task").agg(F.sum("length").alias("tokens"))
    tasks = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task that wrote
    begins = by_task.select("task", F.coalesce(F.sum("tokens").over(tasks), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("task").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    lined = rest.withColumn("at", F.coalesce(F.sum("length").over(inside), F.lit(0))).join(begins, "task").withColumn("at", F.col("at") + F.col("begin"))
    lined = lined.withColumn("s", F.explode(F.sequence(F.floor(F.col("at") / window), F.floor((F.col("at") + F.col("length") - 1) / window))))
    low, high = F.greatest("at", F.col("s") * window), F.least(F.col("at") + F.col("length"), (F.col("s") + 1) * window)
    greedy = lined.select("piece", (low - F.col("at")).alias("skip"), (high - low).alias("length"), (F.lit(main) + F.col("s")).alias("sequence_id"), (low - F.col("s") * window).alias("offset"))
    greedy_count = rest.agg(F.coalesce(F.sum("length"), F.lit(0))).head()[0] // window + 1

    ids = pieces.where(F.col("length") < window).select("piece", "doc_id", "doc_tokens", F.col("start").alias("begin"), "ids")
    cut_ids = F.substring(F.col("ids"), (4 * F.col("skip") + 1).cast("int"), (4 * F.col("length")).cast("int"))
    joined = ids.join(whole.unionByName(greedy), "piece").select(
        "doc_id", (F.col("begin") + F.col("skip")).alias("start"), "length", "doc_tokens", "sequence_id", "offset", cut_ids.alias("ids"))
    full = pieces.where(F.col("length") == window).select(
        "doc_id", "start", "length", "doc_tokens", (F.lit(main + greedy_count) + F.col("piece")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids")
    return joined.unionByName(full)
