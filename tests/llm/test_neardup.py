"""Near-duplicates against all pairs compared in plain Python."""

import random
import re

import pytest

from conftest import SF_SMALL
from tunestats.llm import neardup, registry


def plain_set(t, size):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if x]
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def plain_components(rows, size):
    sets = [(i, plain_set(t, size)) for i, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, len(s), low.get(find(k), None)) for k, (i, s) in enumerate(sets)), key=str)


def got(df, size):
    return sorted((tuple(r) for r in neardup.near_duplicates(df, size=size).collect()), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(60)]
    out, bases = [], [[rng.choice(vocab) for _ in range(rng.randint(30, 120))] for _ in range(6)]
    for _ in range(n):
        kind = rng.random()
        base = list(rng.choice(bases))
        if kind < 0.5:                                        # near copies, some of them of near copies
            for _ in range(rng.randint(0, 5)):
                base[rng.randrange(len(base))] = rng.choice(vocab)
        elif kind < 0.7:                                      # a shared passage with own words around it
            base = passage + [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        elif kind < 0.8:
            base = base[:rng.randint(0, 5)]
        else:
            base = [rng.choice(vocab) for _ in range(rng.randint(1, 80))]
        out.append(" ".join(base))
    return out


@pytest.mark.parametrize("seed,block", [(1, 64), (2, 4)])
def test_equals_all_pairs(spark, seed, block, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows = list(enumerate(corpus(seed, 220))) + [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "One\ttwo"), (905, "x " * 30_000)]
    random.Random(seed).shuffle(rows)
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), 4) == plain_components(rows, 4)


def test_null_ids_repeats_and_clashing_columns(spark):
    long = " ".join(f"v{i}" for i in range(40))
    rows = [(None, long), (5, long), (3, long + " end"), (3, long + " end"), (None, "alone a b c d e"), (8, "x y z"), (8, "other text here now")]
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], "doc_id long, text string, key string, n int, sig int")
    assert got(df, 4) == plain_components(rows, 4)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_large_group_of_near_copies(spark):
    """Every member is linked through a few others, never through all pairs."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(1500):
        words = list(base)
        words[rng.randrange(100)] = f"e{i}"
        rows.append((i, " ".join(words)))
    assert {r[2] for r in got(spark.createDataFrame(rows, "doc_id long, text string"), 4)} == {0}


def test_query_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in registry.op7_minhash(spark, SF_SMALL).collect()), key=str) == plain_components(rows, 4)


def test_a_third_without_an_id_and_one_id_for_many_texts(spark):
    """Documents that share an id, or have none, meet only texts of their own hash."""
    rng = random.Random(3)
    say = lambda n: [f"q{rng.randrange(5000)}" for _ in range(n)]
    rows = []
    for i in range(240):
        words = say(60)
        near = list(words)
        near[rng.randrange(60)] = "changed"
        own = None if i % 3 == 0 else 7 if i % 3 == 1 else 1000 + i
        rows += [(own, " ".join(words)), (own, " ".join(near))] + ([(own, " ".join(words))] if i % 5 == 0 else [])
    # the plain version names a component by its least id, so rows are numbered to be told apart
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row long, doc_id long, text string").repartition(4)
    got_rows = neardup.near_duplicates(df, id_col="row", size=4).collect()
    assert sorted(((r.row, r.n_shingles, r.component_id) for r in got_rows), key=str) == plain_components([(i, t) for i, (_, t) in enumerate(rows)], 4)
    assert len(got(df.select("doc_id", "text"), 4)) == len(rows)
