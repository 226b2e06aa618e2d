"""Language-model scoring by masked pseudo-likelihood.

A network predicts every token from a window on both sides: the embeddings of
the ``WINDOW`` tokens before and after it (a table for each place) are added
and passed through tanh; the token is predicted in two digits, the first from
the hidden layer, the second from the hidden layer and the first digit. The
sum of log P(token | both sides) over a text is its pseudo log-likelihood.

Tokens are lower-case words: the ``TOP`` most frequent words of the corpus,
counted over all documents, are classes of their own, the others share hashed
classes, and the network predicts the class. Within a class a word has its
share of the class's count in the whole corpus: log P(token | both sides) is
log P(class | both sides) + log P(word | class). (How likely a rare word is
within its class does not depend on the words around.) A word that the corpus
does not have counts as one, for which every hashed class keeps a place.

Words are hashed for a whole Arrow batch at once, from the bytes of the texts,
so each of the three passes over the corpus (counting, training, scoring) cuts
the texts for itself and no table of tokens is kept. The counts of all words
are a written table. The logarithms of at most ``FREQUENT`` words go to the
scoring tasks; only the rarer words of the documents are joined to the table,
by a row number that is written with the scores.

Training covers all documents, in ``ROUNDS`` rounds over disjoint parts of them.
Documents are dealt by a hash of their columns to shards of about
``SHARD_TOKENS`` tokens; a shard makes one pass of minibatch gradient steps
(Adagrad, numpy) in order of the hash, from the last round's parameters, and
Spark averages the parameters, weighted by tokens, as whole numbers. So neither
the number of input partitions nor the order of sums shows in the result. What
reaches the driver (the most frequent words, the classes' counts and one set of
parameters a round) is of fixed size.

Defined results: null and empty texts and white space have no tokens, a score
of 0 and no mean; ties in the vocabulary go to the smaller hash; a corpus
without a token leaves the untrained start; repeated rows get equal scores;
texts of any length are read whole, ``SEGMENT`` bytes at a time; other columns
are kept, and a clashing output name is refused with ``ValueError``. Sums of
log P(word | class) are of whole millionths.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunestats.llm.shared import stored as stored_table

DIGIT = 32                       # ids are two digits to this base
IDS = DIGIT * DIGIT              # 0 stands for what is beyond the text
TOP = 768
FREQUENT = 1 << 17               # words whose logarithms are sent to the scoring tasks
WINDOW = 2
WIDTH = 16
BATCH = 4096                     # tokens in a gradient step
RATE = 0.15
ROUNDS = 2                       # rounds of averaging; each takes its share of the documents
SHARD_TOKENS = 4_000_000         # tokens that one task trains on from the same start
UNITS = 100_000                  # parameters are averaged in whole units of 1 / UNITS
MICRO = 1_000_000                # logs within a class are whole millionths, whose sums are exact
SEGMENT = 1 << 19                # bytes of text whose words are hashed at a time
COUNTED = 1 << 20                # words that are counted together before they are sent
_SHAPES = {"E": (2 * WINDOW, IDS, WIDTH), "b": (WIDTH,), "W1": (WIDTH, DIGIT), "b1": (DIGIT,), "W2": (WIDTH, DIGIT), "B2": (DIGIT, DIGIT)}
SIZE = sum(int(np.prod(s)) for s in _SHAPES.values())


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in _SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at:at + n].reshape(shape)
        at += n
    return out


def start(seed: int = 11) -> np.ndarray:
    flat = np.zeros(SIZE, np.float32)
    rng, v = np.random.default_rng(seed), views(flat)
    for name in ("E", "W1", "W2"):
        v[name][:] = rng.normal(0, 0.1, v[name].shape)
    return flat


# ------------------------------------------------------------------ words --
#: A word's hash is mix(sum of LETTERS[byte] * BASE^place, length), modulo 2^64.
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
LETTERS = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and its inverse for i < n; those for a segment are kept."""
    if not _POWERS or len(_POWERS[0]) < n:
        m = max(n, SEGMENT)
        found = [np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(m - 1, b, np.uint64)))) for b in (BASE, BASE_INVERSE)]
        if m > SEGMENT:
            return found[0], found[1]
        _POWERS[:] = found
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray, length: np.ndarray) -> np.ndarray:
    h = h ^ (length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _segment_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the words in ``data``; a word ends at white space
    and before each of ``starts``."""
    word = ~_SPACE[data]
    led = np.zeros(len(data) + 1, bool)                  # whether the byte before goes on to this one
    led[1:] = word
    led[starts] = False
    first = np.flatnonzero(word & ~led[:-1])
    goes_on = np.zeros(len(data), bool)
    goes_on[:-1] = word[1:] & led[1:-1]
    last = np.flatnonzero(word & ~goes_on)
    power, inverse = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(LETTERS[data] * power[:len(data)], out=sums[1:])
    return first, mix((sums[last + 1] - sums[first]) * inverse[first], last + 1 - first)


def word_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, hashes, texts' numbers from there) of runs of
    texts of about ``SEGMENT`` bytes; a longer text comes in several runs."""
    if not len(texts):
        return
    texts = texts.cast(pa.large_string())
    _, places, bytes_ = texts.buffers()
    ends = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(bytes_, np.uint8) if bytes_ is not None and bytes_.size else np.empty(0, np.uint8)
    if texts.null_count and len(data):                   # what lies under a null is no text
        return (yield from word_hashes(texts.fill_null("")))
    at, text = int(ends[0]), 0
    while at < ends[-1]:
        end = int(ends[np.searchsorted(ends, at + SEGMENT, "right") - 1])
        if end <= at:                                    # one long text: up to a white space
            end, whole = at + SEGMENT, int(ends[np.searchsorted(ends, at, "right")])
            while end < whole and not _SPACE[data[end - 1]]:
                stop = min(end + SEGMENT, whole)
                space = np.flatnonzero(_SPACE[data[end:stop]])
                end = end + int(space[0]) + 1 if len(space) else stop
            end = min(end, whole)
        text = int(np.searchsorted(ends, at, "right")) - 1
        inner = ends[text + 1:np.searchsorted(ends, end, "right")]
        first, h = _segment_words(data[at:end], np.unique(np.concatenate(([0], inner - at))))
        yield text, h, np.searchsorted(ends, first + at, "right") - 1 - text
        at = end


def hashes_of(text: str | None) -> np.ndarray:
    """The hashes of one text's words, which are lower-cased first."""
    return np.concatenate([np.empty(0, np.uint64), *(h for _, h, _ in word_hashes(pa.array([(text or "").lower()])))])


class Slots:
    """Values by 64-bit hash, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(4 * len(keys) - 1).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys, self.values, self.used = np.zeros(size, np.uint64), np.zeros(size, values.dtype), np.zeros(size, bool)
        left, probe = np.arange(len(keys)), 0
        while len(left):
            slot = ((keys[left] + np.uint64(probe)) & self.mask).astype(np.int64)
            _, place = np.unique(slot, return_index=True)
            place = place[~self.used[slot[place]]]
            self.keys[slot[place]], self.values[slot[place]], self.used[slot[place]] = keys[left[place]], values[left[place]], True
            left, probe = np.delete(left, place), probe + 1

    def get(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether each is held, its value or 0)"""
        found, out = np.zeros(len(h), bool), np.zeros(len(h), self.values.dtype)
        left, probe = np.arange(len(h)), 0
        while len(left):
            slot = ((h[left] + np.uint64(probe)) & self.mask).astype(np.int64)
            used = self.used[slot]
            same = used & (self.keys[slot] == h[left])
            found[left[same]] = True
            out[left[same]] = self.values[slot[same]]
            left, probe = left[used & ~same], probe + 1
        return found, out


class Vocabulary:
    """Ids of words: 1 to TOP by frequency, above that by hash."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.slots = Slots(hashes, np.arange(1, len(hashes) + 1, dtype=np.int32))

    def ids(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether a class of its own, id)"""
        top, own = self.slots.get(h)
        other = (h % np.uint64(IDS - 1 - TOP)).astype(np.int32) + TOP + 1
        return top, np.where(top, own, other)

    def encode(self, text: str | None) -> np.ndarray:
        return self.ids(hashes_of(text))[1]


# ---------------------------------------------------------------- network --
def padded(ids: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the tokens with room for the window around every text, each one's
    place there); ``of`` is the text of each, ascending."""
    if not len(ids):
        return np.zeros(1, np.int32), np.empty(0, np.int64)
    at = np.arange(len(ids)) + WINDOW * (np.cumsum(np.concatenate(([0], of[1:] != of[:-1]))) + 1)
    out = np.zeros(int(at[-1]) + WINDOW + 1, np.int32)
    out[at] = ids
    return out, at


def around(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The tokens at each place of the window around those at ``at``."""
    return np.stack([tokens[at + o] for o in range(-WINDOW, WINDOW + 1) if o])


def contexts(ids: np.ndarray) -> np.ndarray:
    """The window around every token of one text."""
    return around(*padded(ids, np.zeros(len(ids), np.int64)))


def layers(v: dict[str, np.ndarray], ctx: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hidden layer and what goes into the softmax of either digit; a
    column for each token. ``first``: the tokens' first digits."""
    pre = v["b"] + v["E"][0].take(ctx[0], 0)
    for k in range(1, 2 * WINDOW):
        pre += v["E"][k].take(ctx[k], 0)
    h = np.ascontiguousarray(np.tanh(pre).T)
    return h, v["W1"].T @ h + v["b1"][:, None], v["W2"].T @ h + np.ascontiguousarray(v["B2"].T).take(first, 1)


def _log_at(z: np.ndarray, digit: np.ndarray) -> np.ndarray:
    """The log-softmax of each column at its digit."""
    most = z.max(0)
    return z[digit, np.arange(len(digit))] - most - np.log(np.exp(z - most).sum(0))


def text_logs(v: dict[str, np.ndarray], ids: np.ndarray, of: np.ndarray) -> np.ndarray:
    """log P(token | both sides) of every token of texts; ``of`` is the text of each."""
    tokens, at = padded(ids, of)
    out = np.empty(len(ids))
    for i in range(0, len(ids), BATCH):
        first, second = ids[i:i + BATCH] // DIGIT, ids[i:i + BATCH] % DIGIT
        _, z1, z2 = layers(v, around(tokens, at[i:i + BATCH]), first)
        out[i:i + BATCH] = _log_at(z1, first).astype(np.float64) + _log_at(z2, second)
    return out


def log_probs(v: dict[str, np.ndarray], ids: np.ndarray) -> np.ndarray:
    """log P(token | both sides) of every token of one text."""
    return text_logs(v, ids, np.zeros(len(ids), np.int64))


def _slope(z: np.ndarray, digit: np.ndarray) -> np.ndarray:
    """How the mean negative log-softmax at the digits changes with ``z``."""
    d = np.exp(z - z.max(0))
    d /= d.sum(0)
    d[digit, np.arange(len(digit))] -= 1
    d /= len(digit)
    return d


def gradient(v: dict[str, np.ndarray], ctx: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Gradient of the mean negative log-probability, flat."""
    first, second = ids // DIGIT, ids % DIGIT
    h, z1, z2 = layers(v, ctx, first)
    d1, d2 = _slope(z1, first), _slope(z2, second)
    flat = np.zeros(SIZE, np.float32)
    g = views(flat)
    g["W1"][:], g["b1"][:], g["W2"][:] = h @ d1.T, d1.sum(1), h @ d2.T
    for j in range(DIGIT):
        g["B2"][:, j] = np.bincount(first, d2[j], DIGIT)
    back = (v["W1"] @ d1 + v["W2"] @ d2) * (1 - h * h)
    g["b"][:] = back.sum(1)
    for k in range(2 * WINDOW):
        for j in range(WIDTH):
            g["E"][k, :, j] = np.bincount(ctx[k], back[j], IDS)
    return flat


class Trainer:
    """One pass of gradient steps over texts as they come."""

    def __init__(self, flat: np.ndarray):
        self.flat, self.sums = flat.copy(), np.full(SIZE, 1e-8, np.float32)
        self.held: list[np.ndarray] = []
        self.waiting = self.tokens = 0

    def add(self, ids: np.ndarray) -> None:
        if len(ids):
            self.held.append(ids)
            self.waiting += len(ids)
        if self.waiting >= 8 * BATCH:
            self.flush()

    def flush(self) -> None:
        """Steps of BATCH tokens; the last one may be smaller."""
        if not self.held:
            return
        ids = np.concatenate(self.held)
        tokens, at = padded(ids, np.repeat(np.arange(len(self.held)), list(map(len, self.held))))
        for i in range(0, len(ids), BATCH):
            g = gradient(views(self.flat), around(tokens, at[i:i + BATCH]), ids[i:i + BATCH])
            self.sums += g * g
            self.flat -= RATE * g / np.sqrt(self.sums)
        self.tokens += len(ids)
        self.held, self.waiting = [], 0


# ------------------------------------------------------------------ corpus --
def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(h, count) of all words of all texts: by hash, combined in each task."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words = [], 0
        for batch in batches:
            for _, h, _ in word_hashes(batch.column(0)):
                held.append(h)
                words += len(h)
                if words >= COUNTED:
                    yield _counts(held)
                    held, words = [], 0
        if held:
            yield _counts(held)

    return df.select(F.lower(text_col)).mapInArrow(counted, "h long, count long").groupBy("h").agg(F.sum("count").alias("count"))


def _counts(held: list[np.ndarray]) -> pa.RecordBatch:
    h, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "count"])


def stored(counts: DataFrame) -> DataFrame:
    """The counts as a table in the shared folder, for the vocabulary and the scores."""
    return stored_table(counts, "lmscore-words")


def most_frequent(counts: DataFrame) -> Vocabulary:
    rows = counts.orderBy(F.desc("count"), "h").limit(TOP).collect()
    return Vocabulary(np.array([r["h"] for r in rows], np.int64).view(np.uint64))


def vocabulary(df: DataFrame, text_col: str = "text") -> Vocabulary:
    """The TOP words of all texts."""
    return most_frequent(word_counts(df, text_col))


def dealt(df: DataFrame, text_col: str) -> Column:
    """A hash of all columns by which documents are dealt out: copies of a
    text under many ids go to many shards. (Maps cannot be hashed and are left out.)"""
    others = [F.col(f.name) for f in df.schema.fields if f.name != text_col and "map<" not in f.dataType.simpleString()]
    return F.xxhash64(text_col, *others)


def train(df: DataFrame, vocab: Vocabulary, text_col: str = "text", counts: DataFrame | None = None, rounds: int = ROUNDS,
          shard_tokens: int = SHARD_TOKENS) -> np.ndarray:
    """Parameters after all rounds of averaging over shards."""
    counts = word_counts(df, text_col) if counts is None else counts
    tokens = counts.agg(F.sum("count")).first()[0] or 0
    shards = max(1, -(-tokens // (rounds * shard_tokens)))
    rows = df.select(F.lower(text_col).alias("text"), dealt(df, text_col).alias("key"))
    rows = rows.select("text", "key", F.pmod("key", F.lit(rounds)).alias("round"), F.pmod(F.shiftright("key", 8), F.lit(shards)).cast("int").alias("shard"))
    flat = start()
    for k in range(rounds):
        flat = _round(rows.where(F.col("round") == k), vocab, flat, shards)
    return flat


def _round(rows: DataFrame, vocab: Vocabulary, begin: np.ndarray, shards: int) -> np.ndarray:
    """The mean of what the shards make of ``begin``, each in order of its rows' keys."""

    def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in range(0, batch.num_rows, 1000):
                part = batch.slice(cut, 1000)
                ids: list[list[np.ndarray]] = [[] for _ in range(part.num_rows)]
                for text, h, of in word_hashes(part.column(0)):
                    own = vocab.ids(h)[1].astype(np.int16)
                    bounds = np.searchsorted(of, np.arange(of[-1] + 2)) if len(of) else [0]
                    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        ids[text + i].append(own[a:b])
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), pa.array([b"".join(x.tobytes() for x in own) for own in ids], pa.binary())],
                    names=["key", "shard", "ids"])

    def passes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, place = None, None
        for batch in batches:
            for shard, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                if shard != place:
                    if trainer:
                        yield from _trained(trainer)
                    trainer, place = Trainer(begin), shard
                trainer.add(np.frombuffer(ids.as_py(), np.int16).astype(np.int32))
        if trainer:
            yield from _trained(trainer)

    tasks = rows.select("text", "key", "shard").mapInArrow(coded, "key long, shard int, ids binary")
    order = tasks.repartition(shards, "shard").sortWithinPartitions("shard", "key", "ids").select("shard", "ids")
    mean = order.mapInArrow(passes, "at int, value long, weight long").groupBy("at").agg(F.sum("value").alias("value"), F.sum("weight").alias("weight"))
    found = mean.toArrow()                                  # SIZE rows, whatever the corpus
    flat = begin.astype(np.float64)
    flat[found["at"].to_numpy()] = found["value"].to_numpy() / (UNITS * found["weight"].to_numpy().astype(np.float64))
    return np.round(flat, 5).astype(np.float32)


def _trained(trainer: Trainer) -> Iterator[pa.RecordBatch]:
    trainer.flush()
    if trainer.tokens:
        units = np.round(trainer.flat.astype(np.float64) * UNITS).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(SIZE, dtype=np.int32)), pa.array(units * trainer.tokens), pa.array(np.full(SIZE, trainer.tokens, np.int64))],
            names=["at", "value", "weight"])


def _hashed_class(h: Column) -> Column:
    """The hashed class, from 0, of a word's hash (unsigned, in a long)."""
    m = IDS - 1 - TOP
    return F.pmod(F.pmod(h, F.lit(m)) + F.when(h < 0, 2 ** 64 % m).otherwise(0), F.lit(m)).cast("int")


class Shares:
    """log P(word | class) in whole millionths, for words that are told by the
    corpus's ``counts`` (h, count) to be beyond the vocabulary."""

    def __init__(self, counts: DataFrame, vocab: Vocabulary, frequent: int = FREQUENT):
        top = [int(h) for h in vocab.hashes.view(np.int64)]
        self.table = counts.where(~F.col("h").isin(top)) if top else counts
        self.totals = [1] * (IDS - 1 - TOP)                 # one place for words that the table does not have
        for r in self.table.groupBy(_hashed_class(F.col("h")).alias("c")).agg(F.sum("count").alias("n")).collect():
            self.totals[r["c"]] += r["n"]
        # the most frequent of them, down to a count that leaves at most ``frequent``
        size = F.floor(F.log2("count") * 4).cast("int")
        held, limit = 0, None
        for r in sorted(self.table.groupBy(size.alias("size")).count().collect(), key=lambda r: -r["size"]):
            held += r["count"]
            if held > frequent:
                break
            limit = r["size"]
        self.limit = limit
        near = self.table.where(size >= limit) if limit is not None else self.table.limit(0)
        found = near.select("h", self.log(F.col("count"), F.col("h")).alias("log")).toArrow()
        self.near = Slots(found["h"].to_numpy().astype(np.int64).view(np.uint64), found["log"].to_numpy().astype(np.int64))

    def log(self, count: Column, h: Column) -> Column:
        share = F.log(F.coalesce(count, F.lit(1)).cast("double")) - F.log(F.get(F.array(*map(F.lit, map(float, self.totals))), _hashed_class(h)))
        return F.round(share * MICRO).cast("long")


def score(df: DataFrame, vocab: Vocabulary, flat: np.ndarray, text_col: str = "text", out_col: str = "lm",
          counts: DataFrame | None = None, keep: Sequence[str] | None = None, frequent: int = FREQUENT) -> DataFrame:
    """The columns ``keep`` of ``df`` (all by default) with a struct of tokens and
    summed log-probabilities: of the words, where the corpus's ``counts`` are
    given, else of their classes. With ``counts`` the rows are written to the
    shared folder under a number, by which the rarer words' share is joined."""
    keep = list(df.columns if keep is None else keep)
    if out_col.lower() in {c.lower() for c in keep}:
        raise ValueError(f"the input already has a column {out_col}")
    if hidden_names := {c.lower() for c in keep} & {"_lm", "_row"}:
        raise ValueError(f"the input already has the columns {sorted(hidden_names)}")
    shares = None if counts is None else Shares(counts, vocab, frequent)
    near = None if shares is None else shares.near

    @F.arrow_udf("n_tokens long, log_prob double, micro long, rare array<struct<h:long,n:long>>")
    def scored(texts: pa.Array) -> pa.Array:
        v, out = views(flat), []
        for i in range(0, len(texts), 256):
            own = texts.slice(i, 256)
            runs = [(h, of + text) for text, h, of in word_hashes(own)]
            h = np.concatenate([np.empty(0, np.uint64), *(h for h, _ in runs)])
            of = np.concatenate([np.empty(0, np.int64), *(of for _, of in runs)])
            top, ids = vocab.ids(h)
            micro, rare = np.zeros(len(own), np.int64), _lists(len(own), of[:0], h[:0])
            if near is not None:
                other = np.flatnonzero(~top)
                held, log = near.get(h[other])
                micro = np.bincount(of[other], log, len(own)).astype(np.int64)      # whole numbers, below 2^53
                rare = _lists(len(own), of[other[~held]], h[other[~held]])
            out.append(pa.StructArray.from_arrays(
                [pa.array(np.bincount(of, minlength=len(own))), pa.array(np.bincount(of, text_logs(v, ids, of), len(own))), pa.array(micro), rare],
                names=["n_tokens", "log_prob", "micro", "rare"]))
        return pa.concat_arrays(out) if out else pa.array([], pa.struct([
            ("n_tokens", pa.int64()), ("log_prob", pa.float64()), ("micro", pa.int64()), ("rare", RARE)]))

    rows = df.select(*keep, scored(F.lower(text_col)).alias("_lm"))
    if shares is None:
        return rows.select(*keep, F.struct("_lm.n_tokens", "_lm.log_prob").alias(out_col))
    rows = stored_table(rows.withColumn("_row", F.monotonically_increasing_id()), "lmscore-scores")
    uses = rows.select("_row", F.explode("_lm.rare").alias("r")).select("_row", "r.h", "r.n").join(shares.table, "h", "left")
    rest = uses.groupBy("_row").agg(F.sum(F.col("n") * shares.log(F.col("count"), F.col("h"))).alias("_rest"))
    # a text without rarer words has no row there
    total = F.col("_lm.log_prob") + (F.col("_lm.micro") + F.coalesce("_rest", F.lit(0))) / MICRO
    return rows.join(rest, "_row", "left").select(*keep, F.struct(F.col("_lm.n_tokens").alias("n_tokens"), total.alias("log_prob")).alias(out_col))


RARE = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())]))


def _lists(n: int, of: np.ndarray, h: np.ndarray) -> pa.Array:
    """For each of n texts its distinct hashes and how often each is there."""
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(h)), bool), (of[1:] != of[:-1]) | (h[1:] != h[:-1]))))
    times = np.diff(np.concatenate((first, [len(h)])))
    places = np.searchsorted(of[first], np.arange(n + 1)).astype(np.int32)
    flat = pa.StructArray.from_arrays([pa.array(h[first].view(np.int64)), pa.array(times.astype(np.int64))], names=["h", "n"])
    return pa.ListArray.from_arrays(pa.array(places), flat)
