"""Masked pseudo-likelihood: gradients, plain scores, and what it has learned."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tunestats.llm import lmscore as lm
from tunestats.llm import registry


def plain_score(v, ids):
    total = 0.0
    for t, y in enumerate(ids):
        places = [o for o in range(-lm.WINDOW, lm.WINDOW + 1) if o]
        h = np.tanh(v["b"].astype(float) + sum(v["E"][k][ids[t + o] if 0 <= t + o < len(ids) else 0].astype(float) for k, o in enumerate(places)))
        z1, z2 = h @ v["W1"] + v["b1"], h @ v["W2"] + v["B2"][y // lm.DIGIT]
        total += z1[y // lm.DIGIT] - math.log(np.exp(z1).sum()) + z2[y % lm.DIGIT] - math.log(np.exp(z2).sum())
    return total


def test_gradient_is_the_slope():
    rng = np.random.default_rng(0)
    ids = rng.integers(1, lm.IDS, 50).astype(np.int32)
    flat = lm.start().astype(np.float64) * 3
    ctx = lm.contexts(ids)
    g = lm.gradient(lm.views(flat), ctx, ids)
    loss = lambda f: -lm.log_probs(lm.views(f), ids).mean()
    for at in np.concatenate((rng.choice(lm.SIZE, 30), np.flatnonzero(g)[:60])):
        up, down = flat.copy(), flat.copy()
        up[at] += 1e-4
        down[at] -= 1e-4
        assert abs((loss(up) - loss(down)) / 2e-4 - g[at]) < 1e-5


def test_query_equals_plain_loop(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    vocab = lm.vocabulary(docs)
    flat = lm.train(docs, vocab)
    rows = lm.score(docs, vocab, flat).collect()
    assert len(rows) == docs.count()
    for r in rows[:25]:
        ids = vocab.encode(r.text).tolist()
        assert r.lm.n_tokens == len(ids) and abs(r.lm.log_prob - plain_score(lm.views(flat), ids)) < 1e-3 * (1 + len(ids))
    got = registry.op10_lmscore(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_tokens", "log_prob", "mean_log_prob"] and got.count() == len(rows)


def test_learns_order(spark):
    rng = random.Random(0)
    say = lambda: " ".join(w for _ in range(rng.randint(20, 60)) for w in rng.choice((("red", "sun", "sets"), ("big", "dog", "barks"), ("old", "man", "reads"))))
    texts = [say() for _ in range(800)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    vocab = lm.vocabulary(df)
    flat = lm.train(df, vocab)
    held = [say() for _ in range(30)]
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in held]
    rows = lm.score(spark.createDataFrame([(i, t) for i, t in enumerate(held + mixed)], "doc_id long, text string"), vocab, flat).collect()
    mean = {r.doc_id: r.lm.log_prob / r.lm.n_tokens for r in rows}
    assert all(mean[i] > mean[i + 30] + 0.3 for i in range(30))


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, " \n", 0), (4, "a", 0), (4, "a", 0), (5, "long " * 20_000, 0)], "doc_id long, text string, n_tokens int")
    vocab = lm.vocabulary(df)
    rows = {r.doc_id: r.lm for r in lm.score(df, vocab, lm.train(df, vocab)).collect()}
    assert [(rows[i].n_tokens, rows[i].log_prob) for i in (1, 2, 3)] == [(0, 0.0)] * 3 and rows[4].n_tokens == 1 and rows[5].n_tokens == 20_000
    none = df.limit(0)
    empty = lm.vocabulary(none)
    assert np.abs(lm.train(none, empty) - lm.start()).max() < 1e-5 and lm.score(none, empty, lm.start()).count() == 0
    with pytest.raises(ValueError):
        lm.score(df, vocab, lm.start(), out_col="TEXT")


def test_every_word_has_its_own_probability(spark):
    rng = random.Random(5)
    frequent, rare = [f"f{i}" for i in range(lm.TOP)], [f"r{i}" for i in range(3000)]
    texts = [" ".join(frequent) for _ in range(6)] + [" ".join(rng.choice(rare[:50] if rng.random() < 0.5 else rare) for _ in range(200)) for _ in range(30)]
    given = texts + [texts[10], texts[10], None, "", "f1 f2", "R1 unseen r1"]
    df = spark.createDataFrame([(None if i % 5 == 0 else i % 7, t, i) for i, t in enumerate(given)], "doc_id long, text string, n int")
    corpus = df.where(df["n"] < len(given) - 1)
    counts = lm.stored(lm.word_counts(corpus))
    vocab = lm.most_frequent(counts)
    flat = lm.start()
    every = Counter(w for t in given[:-1] for w in (t or "").lower().split())
    totals = Counter()
    for w, n in every.items():
        totals[int(vocab.encode(w)[0])] += n
    assert len(every) > 2 * lm.IDS
    rows = {r.n: r for r in lm.score(df, vocab, flat, counts=counts).collect()}
    assert len(rows) == len(given)
    for n, t in enumerate(given):
        ids, words = vocab.encode(t).tolist(), (t or "").lower().split()
        own = sum(math.log(max(1, every[w]) / (totals[i] + 1)) for w, i in zip(words, ids) if i > lm.TOP)
        assert rows[n].text == t and abs(rows[n].lm.log_prob - plain_score(lm.views(flat), ids) - own) < 1e-3 * (1 + len(ids))
    # words of one class are told apart
    other = [w for w in every if vocab.encode(w)[0] > lm.TOP]
    a, b = next((a, b) for a in other for b in other if vocab.encode(a) == vocab.encode(b) and every[a] >= 3 * every[b])
    two = {r.text: r.lm.log_prob for r in lm.score(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string"), vocab, flat, counts=counts).collect()}
    assert two[a] > two[b] + 1
    assert registry.op10_lmscore(spark, SF_SMALL).agg(F.max("mean_log_prob")).first()[0] < 0


def plain_hash(word: bytes) -> int:
    """A word's hash, letter by letter."""
    m = (1 << 64) - 1
    h = sum(int(lm.LETTERS[c]) * pow(lm.BASE, i, 1 << 64) for i, c in enumerate(word)) & m
    k = 0xD6E8FEB86659FD93
    h ^= len(word) * k & m
    for _ in range(2):
        h = (h ^ h >> 32) * k & m
    return h ^ h >> 32


def plain_words(text):
    return [plain_hash(w) for w in (text or "").lower().encode().split()]


TEXTS = ["", None, " ", "a", "a a\tb\n\x0bc ", "Ünï  cödé 日本語", "no-break space", "x" * 50, "end ", " start", "the " * 30 + "Ä" * 41]


@pytest.mark.parametrize("segment", [1, 7, 64, 1 << 19])
def test_words_are_cut_and_hashed_as_one_by_one(monkeypatch, segment):
    import pyarrow as pa
    monkeypatch.setattr(lm, "SEGMENT", segment)
    monkeypatch.setattr(lm, "_POWERS", [])
    texts = [None if t is None else t.lower() for t in TEXTS]
    array = pa.array(["cut off", *texts], pa.string()).slice(1)
    got = [[] for _ in texts]
    for text, h, of in lm.word_hashes(array):
        for i, x in zip(of.tolist(), h.tolist()):
            got[text + i].append(x)
    assert got == [plain_words(t) for t in texts]
    assert list(lm.word_hashes(pa.array([], pa.string()))) == []


def test_slots_hold_every_key():
    rng = np.random.default_rng(1)
    keys = np.unique(np.concatenate((rng.integers(0, 1 << 64, 3000, np.uint64), np.arange(40, dtype=np.uint64) << np.uint64(20), [0])).astype(np.uint64))
    slots = lm.Slots(keys, np.arange(len(keys)) + 5)
    held, value = slots.get(np.concatenate((keys, rng.integers(0, 1 << 64, 500, np.uint64))))
    assert held[:len(keys)].all() and not held[len(keys):].any() and (value[:len(keys)] == np.arange(len(keys)) + 5).all()
    assert not lm.Slots(keys[:0], np.arange(0)).get(keys)[0].any()


def plain_query(rows, rounds, shard_tokens, frequent):
    """The registered query in one process: counts, shards, rounds of steps, scores."""
    import xxhash
    signed = lambda h: h - (1 << 64) if h >= 1 << 63 else h
    counts = Counter(h for _, t in rows for h in plain_words(t))
    top = [h for h, _ in sorted(counts.items(), key=lambda x: (-x[1], signed(x[0])))[:lm.TOP]]
    place = {h: i for i, h in enumerate(top, 1)}
    others = lm.IDS - 1 - lm.TOP
    ids = lambda t: [place.get(h) or h % others + lm.TOP + 1 for h in plain_words(t)]
    flat = lm.start()
    shards = max(1, -(-sum(counts.values()) // (rounds * shard_tokens)))
    keyed = []
    for doc_id, t in rows:
        seed = 42 if t is None else xxhash.xxh64_intdigest(t.encode(), 42)
        key = signed(xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), seed))
        keyed.append((key % rounds, (key >> 8) % shards, key, t))
    for k in range(rounds):
        value, weight = np.zeros(lm.SIZE, object), 0
        for shard in range(shards):
            trainer = lm.Trainer(flat)
            for _, t in sorted((key, t) for r, s, key, t in keyed if (r, s) == (k, shard) and t):
                trainer.add(np.array(ids(t), np.int32))
            trainer.flush()
            value = value + np.round(trainer.flat.astype(float) * lm.UNITS).astype(np.int64).astype(object) * trainer.tokens
            weight += trainer.tokens
        flat = np.round(value.astype(float) / (lm.UNITS * float(weight)), 5).astype(np.float32)
    totals = Counter()
    for h, n in counts.items():
        if h not in place:
            totals[h % others] += n
    own = lambda h: round(1e6 * (math.log(counts[h]) - math.log(totals[h % others] + 1))) / 1e6
    return {doc_id: (len(ids(t)), plain_score(lm.views(flat), ids(t)) + sum(own(h) for h in plain_words(t) if h not in place)) for doc_id, t in rows}


def test_registered_query_equals_one_process(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = lm.stored(lm.word_counts(docs))
    vocab = lm.most_frequent(counts)
    want = plain_query(rows, 2, 10_000, 500)
    for parts in (1, 8, 32):                                   # the layout does not show
        df = docs.repartition(parts)
        flat = lm.train(df, vocab, counts=counts, shard_tokens=10_000)
        got = {r.doc_id: (r.lm.n_tokens, r.lm.log_prob) for r in lm.score(df, vocab, flat, counts=counts, keep=["doc_id"], frequent=500).collect()}
        assert got.keys() == want.keys()
        for k, (n, p) in got.items():
            assert n == want[k][0] and abs(p - want[k][1]) <= 1e-5 * max(n, 1)
    full = plain_query(rows, lm.ROUNDS, 4_000_000, 1 << 17)
    for r in registry.op10_lmscore(spark, SF_SMALL).collect():
        assert r.n_tokens == full[r.doc_id][0] and abs(r.log_prob - full[r.doc_id][1]) <= 1e-5 * max(r.n_tokens, 1)


def test_hot_texts_null_ids_and_repeated_rows(spark):
    rows = [(None, "the same words rare1")] * 300 + [(i % 3, None) for i in range(300)] + [(i, f"own word{i} the") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    counts = lm.stored(lm.word_counts(df))
    vocab = lm.most_frequent(counts)
    got = lm.score(df, vocab, lm.train(df, vocab, counts=counts), counts=counts).collect()
    assert len(got) == 900 and len({r.lm.log_prob for r in got if r.text == rows[0][1]}) == 1
    assert all(r.lm.log_prob == 0 for r in got if r.text is None)
