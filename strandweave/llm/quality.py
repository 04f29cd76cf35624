"""Quality by attention-based multiple-instance learning: a document is a bag of passages.

Every passage of the whole text is described by counts of its signs and words, encoded by a
small layer, and weighed by gated attention; the weighted sum of the encodings is scored.  Only
documents carry labels; which passages decide is learned from them.  The model is fitted on the
driver from a bounded sample of labelled documents (``SAMPLE`` per class, at most
``SAMPLE_PASSAGES`` evenly spaced passages of each), its classes weighed back to their share of
all labels; scoring runs in Spark over all passages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

PASSAGE_WORDS = 64
SAMPLE = 1500
SAMPLE_PASSAGES = 16
THRESHOLD = 0.3
HIDDEN, GATE = 16, 8
EPOCHS, RATE, DECAY = 120, 0.03, 1e-4
FOLDS = 5

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "bar": b"|", "bang": b"!?",
    "stop": b".", "comma": b",;:", "odd": b"*#$%&@^~_=+<>\\/`", "quote": b"\"'()[]{}-", "line": b"\n\r",
    "blank": b" \t\x0b\x0c",
}
_NAMES = list(_CLASSES)
_OF_BYTE = np.full(256, len(_NAMES), dtype=np.uint8)  # the rest: other bytes
for _k, _name in enumerate(_NAMES):
    _OF_BYTE[list(_CLASSES[_name])] = _k
_IS_BLANK = np.zeros(256, dtype=bool)
_IS_BLANK[list(b" \t\n\r\x0b\x0c")] = True
WIDTH = len(_NAMES) + 1 + 6


def passages(text: str | None) -> np.ndarray:
    """One row of ``WIDTH`` numbers for every 64 words; one row of zeros for a text without words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return np.zeros((1, WIDTH))
    signs = np.frombuffer(data, dtype=np.uint8)
    blank = _IS_BLANK[signs]
    begins = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    cuts = begins[::PASSAGE_WORDS].copy()
    cuts[0] = 0
    n = len(cuts)
    number = np.zeros(len(signs), dtype=np.int64)
    number[cuts[1:]] = 1
    np.cumsum(number, out=number)
    kinds = len(_NAMES) + 1
    counts = np.bincount(number * kinds + _OF_BYTE[signs], minlength=n * kinds).reshape(n, kinds)
    size = counts.sum(axis=1, keepdims=True)
    last = len(words) - (n - 1) * PASSAGE_WORDS
    per = np.full(n, float(PASSAGE_WORDS))
    per[-1] = last
    unique = np.fromiter((len(set(words[k:k + PASSAGE_WORDS])) for k in range(0, len(words), PASSAGE_WORDS)), float, n)
    same = np.fromiter(map(eq, words, words[1:]), np.int64, len(words) - 1)
    repeats = np.bincount(np.arange(1, len(words)) // PASSAGE_WORDS, weights=same, minlength=n) if len(words) > 1 else np.zeros(n)
    whole = np.full(n, len(set(zip(words, words[1:]))) / max(1, len(words) - 1) if len(words) > 1 else 1.0)
    letters = counts[:, 0] + counts[:, 1] + counts[:, -1]
    return np.column_stack((
        counts / size, unique / per, repeats / per, whole, letters / per / 10, np.log(per) / 4, np.full(n, np.log(len(words)) / 8)))


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    parts: dict[str, np.ndarray]

    def scores(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A score per bag; bag k begins at row ``starts[k]``."""
        return _forward(self.parts, (rows - self.mean) / self.spread, starts)["score"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _forward(p: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    sizes = np.diff(np.append(starts, len(x)))
    bag = np.repeat(np.arange(len(starts)), sizes)
    h = np.tanh(x @ p["encode"] + p["encode_bias"])
    t, g = np.tanh(h @ p["view"]), _sigmoid(h @ p["gate"])
    e = (t * g) @ p["weigh"]
    e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
    a = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(a[:, None] * h, starts)
    return {"bag": bag, "h": h, "t": t, "g": g, "a": a, "z": z, "score": _sigmoid(z @ p["out"] + p["out_bias"])}


def _gradients(p: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
    s = _forward(p, x, starts)
    bag, h, t, g, a, z = (s[k] for k in ("bag", "h", "t", "g", "a", "z"))
    d_out = weights * (s["score"] - labels)
    d_z = d_out[:, None] * p["out"]
    along = (d_z[bag] * h).sum(axis=1)
    d_e = a * (along - np.add.reduceat(a * along, starts)[bag])
    d_t, d_g = d_e[:, None] * p["weigh"] * g, d_e[:, None] * p["weigh"] * t
    d_view, d_gate = d_t * (1 - t * t), d_g * g * (1 - g)
    d_h = a[:, None] * d_z[bag] + d_view @ p["view"].T + d_gate @ p["gate"].T
    d_pre = d_h * (1 - h * h)
    return {
        "encode": x.T @ d_pre, "encode_bias": d_pre.sum(axis=0), "view": h.T @ d_view, "gate": h.T @ d_gate,
        "weigh": (t * g).T @ d_e, "out": z.T @ d_out, "out_bias": d_out.sum(keepdims=True),
    }


def fit(bags: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, seed: int = 0) -> Model:
    """Adam over all bags at once; the same sample gives the same model."""
    draw = np.random.default_rng(seed)
    shape = {"encode": (WIDTH, HIDDEN), "encode_bias": (HIDDEN,), "view": (HIDDEN, GATE), "gate": (HIDDEN, GATE), "weigh": (GATE,), "out": (HIDDEN,), "out_bias": (1,)}
    parts = {k: draw.normal(0, 1 / np.sqrt(s[0]), s) if "bias" not in k else np.zeros(s) for k, s in shape.items()}
    if not bags:
        parts = {k: np.zeros(s) for k, s in shape.items()}
        return Model(np.zeros(WIDTH), np.ones(WIDTH), parts)
    rows = np.concatenate(bags)
    starts = np.cumsum([0] + [len(b) for b in bags[:-1]])
    mean, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    x = (rows - mean) / spread
    weights = weights / weights.sum()
    first, second = ({k: np.zeros_like(v) for k, v in parts.items()} for _ in range(2))
    for step in range(1, EPOCHS + 1):
        for k, d in _gradients(parts, x, starts, labels, weights).items():
            d = d + DECAY * parts[k] * ("bias" not in k)
            first[k] = 0.9 * first[k] + 0.1 * d
            second[k] = 0.99 * second[k] + 0.01 * d * d
            parts[k] = parts[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Model(mean, spread, parts)


def _sampled(text: str) -> Column:
    @F.pandas_udf("array<float>")
    def describe(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            found = []
            for text in batch:
                rows = passages(text)
                if len(rows) > SAMPLE_PASSAGES:
                    rows = rows[np.linspace(0, len(rows) - 1, SAMPLE_PASSAGES).astype(int)]
                found.append(rows.astype(np.float32).ravel())
            yield pd.Series(found)

    return describe(F.col(text))


def _fold(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on labelled documents outside fold 0; the sample is the least hashed ids of each class."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")).where(_fold() != 0)
    totals = {row.quality: row["count"] for row in known.groupBy("quality").count().collect()}  # two classes
    chosen = None
    for quality in (0, 1):
        part = known.where(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most twice the sample's rows
    described = texts.select("doc_id", "quality", _sampled("text").alias("rows"))
    taken = described.groupBy("doc_id", "quality").agg(F.max("rows").alias("rows")).collect()
    taken.sort(key=lambda row: row.doc_id)
    bags = [np.asarray(row.rows, dtype=float).reshape(-1, WIDTH) for row in taken]
    y = np.array([row.quality for row in taken], dtype=float)
    n = {q: max(1, int((y == q).sum())) for q in (0, 1)}
    return fit(bags, y, np.array([totals[row.quality] / n[row.quality] for row in taken]))


def score_column(model: Model, text: str = "text") -> Column:
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([float(model.scores(passages(t), np.zeros(1, dtype=int))[0]) for t in batch], dtype="float64")

    return score(F.col(text))


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    A null text is an empty one, and has a score.  A null id is never held out.  Repeated rows
    share their score.  Without any labels every score is 0.5; an empty table gives no rows.
    """
    score = score_column(train(docs, labels, **options)).alias("score")
    scored = docs.select("doc_id", F.coalesce(_fold() == 0, F.lit(False)).alias("held_out"), score)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs``, all columns kept, without the rows the classifier rejects."""
    model = train(docs, labels, **options)
    return docs.where(score_column(model) >= THRESHOLD)
