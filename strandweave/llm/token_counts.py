"""Token counts: texts are encoded in batches inside Arrow functions, and only lengths come back.

A batch holds pieces of about equally many bytes, whatever the texts' lengths: long texts are
split where no token can reach across, and the counts of their pieces are summed.  Where such
places are depends on the tokenizer, and is read from its file:

* one that drops blanks and never joins what a blank parts is split at every blank; equal
  words are then encoded once per task process, in tables of bounded size;
* a byte-level one starts a token at a single space between letters, so the space opens the
  next piece;
* a sentence-piece one whose pieces hold no blank but in front is split at the same spaces,
  which it puts back itself;
* any other is not split.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from strandweave.llm.common import text_or_empty

LIMIT = 2048
BATCH_CHARS = 1 << 20
PIECE_CHARS = 1 << 16
MEMO_WORDS = 200_000
BULK = 256
_BLANK = re.compile("[ \n\t\r]")
_BETWEEN_LETTERS = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


def _drops_blanks(config: dict) -> bool:
    """Blanks become single spaces and belong to no token; what is left is parted further."""
    normal = config.get("normalizer") or {}
    steps = normal.get("normalizers", [normal])
    cuts = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    replaced = any(s.get("type") == "Replace" and s.get("pattern") == {"Regex": r"\s+"} and s.get("content") == " " for s in steps)
    first = cuts[0] if cuts else {}
    # Everything the pattern does not name is removed, and it names no blank.
    kept = (first.get("pattern") or {}).get("Regex", r"\s")
    removed = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    names_blank = " " in kept or "." in kept or r"\s" in kept.replace(r"[^\s", "[^")
    plain = {s.get("type") for s in steps} <= {"NFC", "Replace", "Lowercase"}
    return plain and replaced and removed and not names_blank


def _byte_level(config: dict) -> bool:
    cut = config.get("pre_tokenizer") or {}
    return config.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")


def split_long(text: str, boundary: re.Pattern | None, keep: bool, most: int = PIECE_CHARS) -> Iterator[str]:
    """Pieces of little more than ``most`` characters, cut at boundaries; ``keep``: the blank opens the next piece."""
    at = 0
    while boundary is not None and len(text) - at > most:
        found = boundary.search(text, at + most)
        if found is None:
            break
        yield text[at:found.start()]
        at = found.start() if keep else found.end()
    yield text[at:]


def balanced(pieces: Iterable[tuple[int, str]], most: int = BATCH_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Lists of pieces that have about ``most`` characters together."""
    batch, size = [], 0
    for piece in pieces:
        batch.append(piece)
        size += len(piece[1])
        if size >= most:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


class LengthCounter:
    """Numbers of tokens, as the tokenizer's library gives them for whole texts."""

    def __init__(self, path: str):
        self.boundary, self.keep, self.by_word = None, False, False
        self.young: dict[str, int] = {"": 0}
        self.old: dict[str, int] = {}
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            named = (self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size()))
            if not any(re.search("[^▁]▁", piece) for piece in named):
                self.boundary = _BETWEEN_LETTERS
            return
        from tokenizers import Tokenizer

        self.pieces = None
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        config = json.loads(self.tokenizer.to_str())
        strings = [token["content"] for token in config.get("added_tokens") or []]
        stripped = any(token.get("lstrip") or token.get("rstrip") or token.get("single_word") for token in config.get("added_tokens") or [])
        if stripped or any(re.search(r"\s", string) for string in strings):
            return  # a special string reaches over blanks
        if _drops_blanks(config):
            self.boundary, self.by_word = _BLANK, True
        elif _byte_level(config):
            self.boundary, self.keep = _BETWEEN_LETTERS, True

    def _encoded(self, texts: list[str]) -> list[int]:
        if self.pieces is not None:
            return [len(ids) for ids in self.pieces.encode(texts, num_threads=1)]
        return [len(e) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), BULK):
            part = words[at:at + BULK]
            of = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False).word_ids
            if None in of:  # a word holds a special string, whose token names no word
                self.young.update(zip(part, self._encoded(part)))
            else:
                self.young.update(zip(part, np.bincount(np.array(of, dtype=np.int64), minlength=len(part)).tolist()))

    def _by_word(self, texts: list[str]) -> list[int]:
        split = [text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for text in texts]
        missing = []
        for word in set().union(*split).difference(self.young):
            known = self.old.get(word)
            if known is None:
                missing.append(word)
            else:
                self.young[word] = known
        self._learn(missing)
        counts = [sum(map(self.young.__getitem__, words)) for words in split]
        if len(self.young) > MEMO_WORDS:
            self.old, self.young = self.young, {"": 0}
        return counts

    def count(self, texts: list[str]) -> np.ndarray:
        totals = np.zeros(len(texts), dtype=np.int64)
        pieces = ((k, piece) for k, text in enumerate(texts) for piece in split_long(text, self.boundary, self.keep))
        for batch in balanced(pieces):
            parts = [piece for _, piece in batch]
            np.add.at(totals, [k for k, _ in batch], self._by_word(parts) if self.by_word else self._encoded(parts))
        return totals


@cache
def _counter(path: str) -> LengthCounter:
    return LengthCounter(path)


def token_count(text: Column, tokenizer: str) -> Column:
    """The number of tokens of each text, without begin, end or added special tokens."""

    @F.pandas_udf("bigint")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(_counter(tokenizer).count([one or "" for one in batch]), dtype="int64")

    return counted(text)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    A null text is empty and has no tokens.  Rows that repeat give repeated results, a null id
    stays null, and an empty table gives no rows.  Only id and text are read; nothing is shuffled.
    """
    counts = docs.select("doc_id", F.octet_length(text_or_empty()).cast("bigint").alias("n_bytes"), token_count(F.col("text"), tokenizer).alias("n_tokens"))
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
