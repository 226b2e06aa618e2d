"""Mixing sources: targets, samples, texts of the mix and odd inputs."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tunestats.llm import mixing

SCHEMA = "doc_id long, text string, source string, note string"


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, epochs=2):
    """Rounds of dealing out and clamping, one source at a time."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, budget = {}, set(order), share * sum(sizes.values())
    while open_:
        level = budget / sum(w[s] for s in open_)
        over = [s for s in open_ if epochs * sizes[s] < level * w[s]]
        if not over:
            return target | {s: level * w[s] for s in open_}
        for s in over:
            target[s] = epochs * sizes[s]
            budget -= target[s]
            open_.discard(s)
    return target


def by_source(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.source].append(r)
    return out


def check(rows, **kw):
    sizes = defaultdict(int)
    for r in rows:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.size == words
        sizes[r.source] += words
    want = plain_targets(sizes, **kw)
    for source, own in by_source(rows).items():
        assert {r.source_size for r in own} == {sizes[source]}
        assert all(r.target == pytest.approx(want[source]) for r in own)
        assert abs(sum(r.taken for r in own) - want[source]) <= 0.5 + 1e-6
        assert all(0 <= r.taken <= 2 * r.size for r in own)


def docs(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(i * i % 23)), "abcde"[i * 7 % 5] if i % 9 else None, None) for i in range(300)]
    rows += [(1000, "long " * 20_000, "c", "very long"), (1001, None, "f", None), (1002, "", "f", None), (None, "no id", "a", None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_targets_and_samples(spark):
    got = mixing.mix(docs(spark)).collect()
    assert len(got) == 304
    check(got)


def test_same_sample_for_any_layout(spark):
    df = docs(spark)
    runs = [sorted((r.doc_id or -1, r.taken) for r in mixing.mix(df.repartition(n), keep=["doc_id"]).collect()) for n in (1, 13)]
    assert runs[0] == runs[1]
    other = sorted((r.doc_id or -1, r.taken) for r in mixing.mix(df, keep=["doc_id"], seed=14).collect())
    assert other != runs[0]


def test_equal_rows_are_drawn_one_by_one(spark):
    rows = [(7, "the very same text here", "a", None)] * 400 + [(i, "a b c d e f g", "b", None) for i in range(500)]
    check(mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect())


def test_clamped_sources_leave_their_excess(spark):
    sources = spark.createDataFrame([("a", 10, 3), ("b", 1000, 1), ("c", 50, 2), ("d", 0, 3), ("e", 900, 1)],
                                    "_source string, source_size long, weight int")
    got = {r._source: r.target for r in mixing.water_fill(sources).collect()}
    assert got["a"] == 20 and got["c"] == 100 and got["d"] == 0
    assert sum(got.values()) == pytest.approx(1.5 * 1960)
    full = {r._source: r.target for r in mixing.water_fill(sources, share=2.5).collect()}
    assert full == {"a": 20, "b": 2000, "c": 100, "d": 0, "e": 1800}


def test_texts_of_the_mix(spark):
    mixed = mixing.mix(docs(spark))
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    got = {r.doc_id: r.n for r in mixing.copies(mixed).groupBy("doc_id").agg(F.sum(words).alias("n")).collect()}
    assert got == {r.doc_id: r.taken for r in mixed.where("taken > 0").collect()}


def test_empty_table_no_words_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).columns == ["doc_id", "text", "source", "note", "size", "source_size", "target", "taken"]
    assert mixing.mix(empty).count() == 0
    got = mixing.mix(spark.createDataFrame([(1, " \n", None, None), (2, None, "a", None)], SCHEMA)).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2
    with pytest.raises(ValueError):
        mixing.mix(empty.withColumn("Taken", F.lit(1)))
