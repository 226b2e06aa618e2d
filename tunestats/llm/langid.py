"""Language identification by averaged hashed subword embeddings.

Every run of letters, with its borders, gives character 2-, 3- and 4-grams,
hashed into ``BUCKETS`` rows of an embedding table. A text is the mean of its
rows; a linear softmax over it is trained with the table by stochastic
gradient descent in numpy. A temperature, fitted on rows that took no part in
training, calibrates the probabilities, and a threshold below which a
prediction is marked as rejected is set there too, so that at most
``REJECTED`` of the right predictions fall under it.

Training reads a bounded sample (one labelled text of each of about ``fit_rows``
ids, of a long text ``fit_chars`` characters in a row); prediction reads every
text whole.

Defined results: a null text or one without a letter is ``und`` with score 0;
without labelled rows everything is ``und``; with one language its score is 1;
ties go to the first language in sorted order; repeated rows get equal
results; the input's columns are kept, and output names that it has already
are refused with ``ValueError``.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunestats.llm.sampling import about, block_of

FIT_ROWS = 4000
FIT_CHARS = 20_000
BUCKETS = 1 << 15
WIDTH = 16               # embedding size
EPOCHS = 6
BATCH = 16
RATE = 2.0
REJECTED = 0.005
SPAN = 1 << 16           # characters handled at a time
RESULT = "lang string, score double, rejected boolean"

_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.frombuffer(bytes(chr(c).isalpha() for c in range(sys.maxunicode + 1)), np.bool_)
    return _LETTERS


def subwords(text: str) -> list[np.ndarray]:
    """Buckets of the text's subwords, in spans of bounded size (grams that
    lie across two spans are in the later one)."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    out = []
    for i in range(0, len(points), SPAN):
        span = points[max(0, i - 3):i + SPAN]
        new = i - max(0, i - 3)                        # grams must end at or after this place
        known = _letters()[span]
        if not known.any():
            continue
        c = np.where(known, span, 32).astype(np.uint64)
        if i == 0:
            c, known, new = np.concatenate(([32], c)).astype(np.uint64), np.concatenate(([False], known)), 0
        if i + SPAN >= len(points):
            c, known = np.concatenate((c, [32])).astype(np.uint64), np.concatenate((known, [False]))
        h, live = c.copy(), known.copy()
        for n in (2, 3, 4):
            h = h[:-1] * np.uint64(0x100000001B3) + c[n - 1:]
            # a gram has a letter, and a border only at its ends
            live = known[:len(h)] | known[n - 1:]
            for k in range(1, n - 1):
                live &= known[k:k + len(h)]
            at = np.flatnonzero(live)
            if new:
                at = at[at + n - 1 >= new]
            mixed = (h[at] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            out.append((mixed >> np.uint64(49)).astype(np.int64))
    return out


@dataclass
class LanguageModel:
    """Logits by bucket (the embedding table times the softmax weights)."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, text: str | None) -> np.ndarray | None:
        """None for a text without a letter."""
        total, n = np.zeros(len(self.langs)), 0
        for grams in subwords(text) if text else ():
            total += np.bincount(grams, minlength=BUCKETS) @ self.table if len(grams) > BUCKETS else self.table[grams].sum(0)
            n += len(grams)
        return total / n + self.bias if n else None

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        z = self.logits(text) if self.langs else None
        if z is None:
            return "und", 0.0, True
        p = softmax(z[None] / self.temperature)[0]
        best = int(np.argmax(p))
        return self.langs[best], float(p[best]), bool(p[best] < self.threshold)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(texts: list[str], langs: list[str], seed: int = 0) -> LanguageModel:
    """Stochastic gradient descent over the texts; their last quarter
    calibrates."""
    names = sorted(set(langs))
    data = []
    for text, lang in zip(texts, langs):
        grams = subwords(text)
        if grams:
            where, counts = np.unique(np.concatenate(grams), return_counts=True)
            data.append((where, (counts / counts.sum())[:, None], names.index(lang)))
    if not data:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH))
    weights, bias = np.zeros((WIDTH, len(names))), np.zeros(len(names))
    cut = max(1, len(data) * 3 // 4)
    fitted, rest = data[:cut], data[cut:] or data
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(fitted))
        for i in range(0, len(order), BATCH):
            part = [fitted[k] for k in order[i:i + BATCH]]
            mean = np.stack([(table[w] * c).sum(0) for w, c, _ in part])
            err = softmax(mean @ weights + bias)
            err[np.arange(len(part)), [y for _, _, y in part]] -= 1
            err /= len(part)
            back = err @ weights.T
            weights -= rate * mean.T @ err
            bias -= rate * err.sum(0)
            for (w, c, _), g in zip(part, back):
                table[w] -= rate * len(part) * c * g
    model = LanguageModel(names, (table @ weights).astype(np.float32), bias)
    z = np.stack([(model.table[w] * c).sum(0) for w, c, _ in rest]) + bias
    y = np.array([k for *_, k in rest])
    temperatures = np.geomspace(0.05, 8, 60)
    losses = [-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in temperatures]
    model.temperature = float(temperatures[int(np.argmin(losses))])
    p = softmax(z / model.temperature)
    right = p.max(1)[p.argmax(1) == y]
    model.threshold = float(np.quantile(right, REJECTED)) if len(right) else 0.0
    return model


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        fit_rows: int = FIT_ROWS, fit_chars: int = FIT_CHARS) -> LanguageModel:
    """Train on a bounded sample of ``labelled`` (its caller leaves held out
    rows away); rows without text, language or id are not read."""
    rows = labelled.select(labelled[id_col].alias("id"), labelled[text_col].alias("text"), labelled[lang_col].alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("text", block_of(F.col("text"), fit_chars))
    sample = about(rows, "id", fit_rows, "lang", "text").select(F.xxhash64("id").alias("at"), "lang", "text").toArrow().to_pylist()
    sample.sort(key=lambda r: (r["at"], r["text"], r["lang"]))
    return train([r["text"] for r in sample], [r["lang"] for r in sample])


def predict(df: DataFrame, model: LanguageModel, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``df`` with a struct of language, score and rejection for each text."""
    if out_col.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the input already has a column {out_col}")

    @F.arrow_udf(RESULT)
    def told(texts: pa.Array) -> pa.Array:
        got = [model.predict(t) for t in texts.to_pylist()]
        cols = list(zip(*got)) if got else [(), (), ()]
        return pa.StructArray.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.bool_())],
                                          names=["lang", "score", "rejected"])

    return df.withColumn(out_col, told(df[text_col]))
