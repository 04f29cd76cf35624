"""Alignment of two tokenizers' ids over a corpus, with an identity map as the fast path.

A text is cut where a single space parts two words: both tokenizers start a token there, so
tokens, byte offsets and groups of a unit depend on the unit alone, and units met before are
looked up in tables of bounded size.  Within a unit the byte offsets at which tokens of A and of
B both end cut them into groups; all A-B pairs of a group are linked.

Nearly all groups are one A token and the one B token of the same bytes.  Which B id that is,
is known before any text is read: an array maps every A id to it.  How many documents hold such
a link is counted in a vector as long as A's vocabulary.  Only the other pairs are shuffled:
every chunk of documents sends each of them once, with its number of documents.  The totals go
back to the chunks that hold the pair, and each chunk's documents sum them up; nothing that
grows with the corpus is broadcast.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from strandweave.llm.common import SMALL_BATCHES, settings
from strandweave.tables import Workspace

CHUNK_CHARS = 4 << 20
MEMO_UNITS = 150_000
BULK = 1 << 14
_UNEVEN = re.compile(r" (?:(?=[\s᠎])|(?<=[\s᠎] ))")
_EDGE = re.compile(r"[\s᠎]")
_PART = re.compile(r"(?<=[^\s᠎]) (?=[^\s᠎])")


def _bytes_of_signs() -> dict[str, int]:
    """The sign that stands for each byte in byte-level vocabularies: itself if it is printable."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)).difference(shown))
    return {**{chr(byte): byte for byte in shown}, **{chr(256 + k): byte for k, byte in enumerate(hidden)}}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the map from A ids to the B ids of the same bytes."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        signs, names = _bytes_of_signs(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            known = all(sign in signs for sign in name)
            self.a_bytes[i] = bytes(signs[sign] for sign in name) if known else name.encode()
        self.b_bytes, single, whole = [], {}, {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
                single.setdefault(self.b_bytes[-1], i)
            else:
                self.b_bytes.append(piece.replace("▁", " ").encode())
                if not (self.b.is_control(i) or self.b.is_unknown(i)):
                    whole.setdefault(self.b_bytes[-1], i)
        same = {**single, **whole}
        self.same = np.array([same.get(x, -1) for x in self.a_bytes], dtype=np.int64)
        self.a_sizes = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        # The text of a group of one A token and the B token of the same bytes.
        self.a_text = [str(i) for i in range(len(self.a_bytes))]
        self.same_text = [f"{i}|{j}" for i, j in enumerate(self.same.tolist())]
        # A pair is one number: the A id times the number of B ids, plus the B id.
        self.width = len(self.b_bytes)
        self.pair = np.dtype("<u4" if len(self.a_bytes) * self.width <= 1 << 32 else "<i8")
        config = json.loads(self.a.to_str())
        cut = config.get("pre_tokenizer") or {}
        joins = any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        # Whether a space between words opens a token of both: then units can be encoded apart.
        self.parts = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and config.get("normalizer") is None and not joins

    def units(self, text: str) -> list[str]:
        """The text without its parting spaces; each unit is encoded with a space in front."""
        if not self.parts:
            return [text]
        uneven = _EDGE.match(text[0]) or _EDGE.match(text[-1]) or _UNEVEN.search(text)
        return _PART.split(text) if uneven else text.split(" ")

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A ids and their numbers per unit, B ids and theirs."""
        encoded = self.a.encode([" " + unit for unit in units], is_pretokenized=True, add_special_tokens=False)
        a = np.array(encoded.ids, dtype=np.int64)
        n_a = np.bincount(np.array(encoded.word_ids, dtype=np.int64), minlength=len(units))
        lists = self.b.encode(units, num_threads=1)
        n_b = np.array(list(map(len, lists)), dtype=np.int64)
        return a, n_a, np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(n_b.sum())), n_b


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions start, start + 1 ... of every run, laid end to end."""
    return np.arange(counts.sum()) + np.repeat(starts - _starts(counts), counts)


class Unit(NamedTuple):
    """What a unit adds to a document: numbers of tokens and groups, its pairs, its groups in text."""

    n_a: int
    n_b: int
    n_groups: int
    pairs: bytes
    text: str


def align(vocabularies: Vocabularies, units: list[str]) -> list[Unit | None]:
    """Each unit's groups and links; None if its tokens' bytes are not the unit's."""
    a, n_a, b, n_b = vocabularies.encode(units)
    plain = (" " + " ".join(units)).encode()
    wanted = np.array(list(map(len, units if plain.isascii() else map(str.encode, units))), dtype=np.int64) + 1
    a_joined, b_joined = b"".join(map(vocabularies.a_bytes.__getitem__, a.tolist())), b"".join(map(vocabularies.b_bytes.__getitem__, b.tolist()))
    a_unit, b_unit = np.repeat(np.arange(len(units)), n_a), np.repeat(np.arange(len(units)), n_b)
    good = np.ones(len(units), dtype=bool)
    if not a_joined == plain == b_joined:
        sizes = [np.bincount(u, weights=s[ids], minlength=len(units)).astype(np.int64) for u, s, ids in (
            (a_unit, vocabularies.a_sizes, a), (b_unit, vocabularies.b_sizes, b))]
        begin_a, begin_b, begin = (_starts(x).tolist() for x in (*sizes, wanted))
        for k in range(len(units)):
            text = plain[begin[k]:begin[k] + wanted[k]]
            good[k] = text == a_joined[begin_a[k]:begin_a[k] + sizes[0][k]] == b_joined[begin_b[k]:begin_b[k] + sizes[1][k]]
        keep_a, keep_b = good[a_unit], good[b_unit]
        a, b, a_unit, b_unit = a[keep_a], b[keep_b], a_unit[keep_a], b_unit[keep_b]
    a_ends, b_ends = np.cumsum(vocabularies.a_sizes[a]), np.cumsum(vocabularies.b_sizes[b])
    both = np.searchsorted(b_ends, a_ends)
    ends = a_ends[b_ends[np.minimum(both, len(b_ends) - 1)] == a_ends] if len(a_ends) else a_ends
    a_group, b_group = np.searchsorted(ends, a_ends), np.searchsorted(ends, b_ends)
    of_a, of_b = np.bincount(a_group, minlength=len(ends)), np.bincount(b_group, minlength=len(ends))
    begin_a, begin_b = _starts(of_a), _starts(of_b)
    repeats = of_b[a_group]
    pairs = np.repeat(a, repeats) * vocabularies.width + b[_spread(begin_b[a_group], repeats)]
    group_unit = a_unit[begin_a]
    links = np.bincount(np.repeat(a_unit, repeats), minlength=len(units))
    groups = np.bincount(group_unit, minlength=len(units))
    n_a, n_b = np.bincount(a_unit, minlength=len(units)).tolist(), np.bincount(b_unit, minlength=len(units)).tolist()
    first_a, of_same = a[begin_a], np.zeros(len(ends), dtype=bool)
    of_same[:] = (of_a == 1) & (of_b == 1)
    of_same[of_same] = vocabularies.same[first_a[of_same]] == b[begin_b[of_same]]
    shown = list(map(vocabularies.same_text.__getitem__, first_a.tolist()))
    other = np.flatnonzero(~of_same)
    a_text, b_text = list(map(vocabularies.a_text.__getitem__, a.tolist())), b.tolist()
    for g, i, n, j, m in zip(*(x.tolist() for x in (other, begin_a[other], of_a[other], begin_b[other], of_b[other]))):
        shown[g] = f"{','.join(a_text[i:i + n])}|{','.join(map(str, b_text[j:j + m]))}"
    data, found, size = pairs.astype(vocabularies.pair).tobytes(), [], vocabularies.pair.itemsize
    link, first = (size * _starts(links)).tolist(), _starts(groups).tolist()
    for ok, at, n, begin, count, x, y in zip(good.tolist(), first, groups.tolist(), link, (size * links).tolist(), n_a, n_b):
        found.append(Unit(x, y, n, data[begin:begin + count], shown[at] if n == 1 else ";".join(shown[at:at + n])) if ok else None)
    return found


NOTHING = Unit(0, 0, 0, b"", "")


class Aligner:
    """Units of texts, from two generations of bounded tables or aligned anew."""

    def __init__(self, a_path: str, b_path: str):
        self.vocabularies = Vocabularies(a_path, b_path)
        self.young: dict[str, Unit | None] = {}
        self.old: dict[str, Unit | None] = {}

    def look_up(self, units: list[str]) -> list[Unit | None]:
        """What ``align`` gives for each of these different units."""
        if len(self.young) > MEMO_UNITS:
            self.old, self.young = self.young, {}
        missing = []
        for unit in set(units).difference(self.young):
            if unit in self.old:
                self.young[unit] = self.old[unit]
            else:
                missing.append(unit)
        for at in range(0, len(missing), BULK):
            part = missing[at:at + BULK]
            self.young.update(zip(part, align(self.vocabularies, part)))
        return list(map(self.young.__getitem__, units))


@cache
def _aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


CHUNKS = ("chunk bigint, summary boolean, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
          "groups_sha256 string, pairs binary, times binary")


def chunk_rows(aligner: Aligner, ids: list, texts: list[str], regular: np.ndarray) -> tuple[list[tuple], tuple[bytes, bytes]]:
    """A row per document, and of the pairs that the identity map does not hold: ids, and documents here.

    ``regular`` counts, by A id, the documents that link it to its B id of the same bytes.
    """
    v = aligner.vocabularies
    split = [v.units(text) if text else [] for text in texts]
    distinct = list(set().union(*split))
    found = aligner.look_up(distinct)
    local = dict(zip(distinct, range(len(distinct))))
    bad = np.array([unit is None for unit in found], dtype=bool)
    table = [unit or NOTHING for unit in found]
    shown, numbers = [unit.text for unit in table], np.array([unit[:3] for unit in table], dtype=np.int64).reshape(-1, 3)
    rows, owner, uses = [], [], []
    for k, units in enumerate(split):
        if units:
            places = list(map(local.__getitem__, units))
            used = np.array(places, dtype=np.int64)
            if not bad[used].any():
                digest = hashlib.sha256(";".join(map(shown.__getitem__, places)).encode()).hexdigest()
                rows.append((ids[k], *numbers[used].sum(axis=0).tolist(), digest))
                uses.append(used)
                owner.append(np.full(len(used), k, dtype=np.int64))
                continue
        rows.append((ids[k], 0, 0, 0, ""))
    if not uses:
        return [(*row, 0, b"", b"") for row in rows], (b"", b"")
    # Units of texts that do not align count nowhere.
    uses, owner = np.concatenate(uses), np.concatenate(owner)
    kept = np.zeros(len(table), dtype=bool)
    kept[uses] = True
    data = [unit.pairs if keep else b"" for unit, keep in zip(table, kept.tolist())]
    sizes, pairs = np.array(list(map(len, data)), dtype=np.int64) // v.pair.itemsize, np.frombuffer(b"".join(data), dtype=v.pair)
    values, places = np.unique(pairs, return_inverse=True)
    owned, repeats = np.unique(owner * len(table) + uses, return_counts=True)
    doc, unit = np.divmod(owned, len(table))
    n = sizes[unit]
    keys = np.repeat(doc, n) * len(values) + places[_spread(_starts(sizes)[unit], n)]
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], np.repeat(repeats, n)[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    times = np.add.reduceat(times, first)
    doc, place = np.divmod(keys[first], len(values))
    a, b = np.divmod(values.astype(np.int64), v.width)
    same = v.same[a] == b
    docs = np.bincount(place, minlength=len(values))
    regular[a[same]] += docs[same]
    cuts = np.searchsorted(doc, np.arange(len(rows) + 1)).tolist()
    links = np.bincount(doc, weights=times, minlength=len(rows)).astype(np.int64).tolist()
    held, often = values[place], times.astype("<u4")
    result = [(*row, links[k], held[cuts[k]:cuts[k + 1]].tobytes(), often[cuts[k]:cuts[k + 1]].tobytes()) for k, row in enumerate(rows)]
    return result, (values[~same].astype("<i8").tobytes(), docs[~same].astype("<i8").tobytes())


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["chunk", "summary", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
    return frame.astype({"doc_id": "Int64"})


def _chunks(a_path: str, b_path: str):
    """Rows of documents, a summary row per chunk (chunk, pairs, documents), and one of the task's vector (chunk -1)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner, number = _aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        regular = np.zeros(len(aligner.vocabularies.same), dtype=np.int64)
        ids, texts, size = [], [], 0

        def flush():
            gc.disable()  # a search for cycles would go through all known units, and none has one
            rows, (pairs, docs) = chunk_rows(aligner, ids, texts, regular)
            gc.enable()
            out = [(number, False, i, n_a, n_b, n_groups, n_links, digest, p, t) for i, n_a, n_b, n_groups, digest, n_links, p, t in rows]
            return _frame([*out, (number, True, None, 0, 0, 0, 0, "", pairs, docs)])

        for batch in batches:
            for i, text in zip(batch["doc_id"].astype("Int64").tolist(), batch["text"]):
                ids.append(None if i is pd.NA else i)
                texts.append(text or "")
                size += len(texts[-1])
                if size >= CHUNK_CHARS:
                    yield flush()
                    ids, texts, size, number = [], [], 0, number + 1
        if ids:
            yield flush()
        used = np.flatnonzero(regular)
        if len(used):
            yield _frame([(-1, True, None, 0, 0, 0, 0, "", used.tobytes(), regular[used].tobytes())])

    return run


def _pairs_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (chunk, pair, docs) of summary rows."""
    for batch in batches:
        for chunk, pairs, docs in zip(batch["chunk"], batch["pairs"], batch["times"]):
            yield pd.DataFrame({"chunk": chunk, "pair": np.frombuffer(pairs, dtype=np.int64), "docs": np.frombuffer(docs, dtype=np.int64)})


def _sums(width: int, kind: np.dtype, same: np.ndarray, regular, best):
    """Per document the numbers of best links and the counts of all, from the totals of its chunk's pairs."""

    def add(docs: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(totals["pair"].to_numpy(dtype=np.int64))
        known, counts = totals["pair"].to_numpy(dtype=np.int64)[order], totals["total"].to_numpy(dtype=np.int64)[order]
        pairs = np.frombuffer(b"".join(docs["pairs"]), dtype=kind).astype(np.int64)
        times = np.frombuffer(b"".join(docs["times"]), dtype="<u4").astype(np.int64)
        a, b = np.divmod(pairs, width)
        identical = same[a] == b
        count = np.where(identical, regular.value[a], 0)
        count[~identical] = counts[np.searchsorted(known, pairs[~identical])]
        owner = np.repeat(np.arange(len(docs)), [len(x) // kind.itemsize for x in docs["pairs"]])
        n_best, count_sum = np.zeros(len(docs), dtype=np.int64), np.zeros(len(docs), dtype=np.int64)
        np.add.at(n_best, owner, np.where(count == best.value[a], times, 0))
        np.add.at(count_sum, owner, count * times)
        result = docs[["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]].copy()
        result["doc_id"] = result["doc_id"].astype("Int64")
        result["n_best"], result["count_sum"] = n_best, count_sum
        return result

    return add


def align_documents(docs: DataFrame, workspace: Workspace, a_path: str, b_path: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A text that is null, empty, or whose joined A or B bytes differ from a space and the text
    has no tokens: zeros, and an empty digest.  Rows that repeat are documents of their own and
    count each.  A null id stays null.  An empty table gives no rows.  Only id and text are read.
    """
    spark, path = docs.sparkSession, workspace.folder("chunks")
    with settings(spark, SMALL_BATCHES):
        rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(_chunks(a_path, b_path), CHUNKS)
        rows.write.partitionBy("summary").option("compression", "zstd").parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    found = rows.where("summary").select("chunk", "pairs", "times").mapInPandas(_pairs_of, "chunk bigint, pair bigint, docs bigint")
    found = workspace.write(found, "pairs")

    # Two vectors as long as A's vocabulary, which bounds them whatever the corpus.
    vocabularies = Vocabularies(a_path, b_path)
    regular = np.zeros(len(vocabularies.same), dtype=np.int64)
    for row in found.where("chunk = -1").groupBy("pair").agg(F.sum("docs").alias("docs")).collect():
        regular[row.pair] = row.docs
    totals = workspace.write(found.where("chunk >= 0").groupBy("pair").agg(F.sum("docs").alias("total")), "totals")
    best = regular.copy()
    a_id = F.expr(f"pair div {vocabularies.width}")
    for row in totals.groupBy(a_id.alias("a")).agg(F.max("total").alias("most")).collect():
        best[row.a] = max(best[row.a], row.most)

    sent = spark.sparkContext.broadcast(regular), spark.sparkContext.broadcast(best)
    own = found.where("chunk >= 0").select("chunk", "pair").join(totals, "pair").select("chunk", "pair", "total")
    every = rows.where("not summary").select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times")
    result = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint"
    summed = every.groupBy("chunk").cogroup(own.groupBy("chunk")).applyInPandas(_sums(vocabularies.width, vocabularies.pair, vocabularies.same, *sent), result)
    return summed.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
