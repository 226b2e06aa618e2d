"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled
texts. A text is compressed in blocks with either; where the good dictionary
compresses better, the text is more like the good ones. The difference of the
two sizes over their sum is calibrated by a logistic fit (with the text's
length, on which the difference's spread depends, and the mean ratio of
compression) on labelled rows that took no part in the dictionaries.

The fit reads a bounded sample: one text of each of about ``fit_rows`` labelled
ids, of a long text ``fit_chars`` characters in a row; two thirds of them are for
the dictionaries.
Scoring reads every text whole, block by block, in bounded memory.

Defined results: null and empty texts are scored as the empty text; rows with
a null label or id are not learned from, and of an id's labels the smallest
counts; without labels of both kinds the score is the share of good labels
(0.5 without any); repeated rows get equal scores; columns of the input are
kept, and output names that it has already are refused with ``ValueError``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunestats.llm.sampling import about, block_of

FIT_ROWS = 6000          # labelled rows, about, that the fit reads
FIT_CHARS = 20_000       # characters in a row that the fit reads of a text
DICT_BYTES = 256 << 10   # size of either dictionary
BLOCK = 1024             # bytes compressed at a time
LEVEL = 3


def _blocks(data: bytes, size: int) -> list[bytes]:
    return [data[i:i + size] for i in range(0, len(data), size)] or [b""]


def _dictionary(texts: list[bytes]) -> bytes:
    """A dictionary trained on the texts; their plain concatenation where
    they are too few for training."""
    pieces = [p for t in texts for p in _blocks(t, 2048)]
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(1024, sum(map(len, pieces)) // 4)), pieces, k=512, d=8,
                                          f=20, split_point=1.0, accel=1).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(pieces)[:DICT_BYTES]


@dataclass
class CompressionModel:
    """Two dictionaries and the calibration; picklable."""

    good: bytes
    bad: bytes
    weights: np.ndarray | None = None
    prior: float = 0.5

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _tools(self):
        if not hasattr(self, "_made"):
            self._made = []
            for data in (self.good, self.bad):
                d = zstandard.ZstdCompressionDict(data)
                d.precompute_compress(level=LEVEL)
                self._made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False,
                                                           write_content_size=False, write_dict_id=False))
        return self._made

    def features(self, text: str | None) -> tuple[float, ...]:
        data = (text or "").encode("utf-8")
        good, bad = self._tools()
        a = b = 0
        for block in _blocks(data, BLOCK):
            a += len(good.compress(block))
            b += len(bad.compress(block))
        size = max(len(data), 1)
        diff, length, ratio = (b - a) / (a + b), np.log(size), min((a + b) / (2 * size), 2.0)
        return diff, length, diff * length, ratio, ratio * ratio, 1.0

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.prior)
        x = np.array([self.features(t) for t in texts]).reshape(len(texts), 6)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic fit by Newton's steps; the last column of ``x``
    is the constant."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    mean[-1], spread[-1] = 0, 1
    z, w = (x - mean) / spread, np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + ridge * w
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), grad)
    w = w / spread
    w[-1] -= (w[:-1] * mean[:-1]).sum()
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", fit_rows: int = FIT_ROWS, fit_chars: int = FIT_CHARS) -> CompressionModel:
    """Learn from the documents that ``labels`` names (its caller leaves held
    out rows away)."""
    marked = (labels.select(labels[id_col].alias("id"), labels[label_col].alias("label"))
              .where("id is not null and label is not null").groupBy("id").agg(F.min("label").alias("label")))
    marked = about(marked, "id", fit_rows, "label")
    texts = docs.select(docs[id_col].alias("id"), block_of(docs[text_col], fit_chars).alias("text")).where("text is not null")
    # the sample has about fit_rows rows of two numbers: a proven bound for the broadcast
    known = about(texts.join(F.broadcast(marked), "id"), "id", fit_rows, "label", "text")
    rows = known.select(F.xxhash64("id").alias("at"), "label", "text").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["at"], r["text"]))
    prior = sum(r["label"] == 1 for r in rows) / len(rows) if rows else 0.5
    cut = len(rows) * 2 // 3
    sides = [[r["text"].encode("utf-8") for r in rows[:cut] if (r["label"] == 1) == good] for good in (True, False)]
    rest = rows[cut:]
    y = np.array([float(r["label"] == 1) for r in rest])
    if not all(any(s) for s in sides) or len(set(y)) < 2:
        return CompressionModel(b"", b"", None, prior)
    model = CompressionModel(_dictionary(sides[0]), _dictionary(sides[1]), None, prior)
    model.weights = logistic(np.array([model.features(r["text"]) for r in rest]), y)
    return model


def score_column(text: Column, model: CompressionModel) -> Column:
    """The calibrated score of a text column, from 0 to 1."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(texts.to_pylist()), pa.float64())

    return score(text)


def score(df: DataFrame, model: CompressionModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``df`` with the score of every whole text."""
    if score_col.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the input already has a column {score_col}")
    return df.withColumn(score_col, score_column(df[text_col], model))
