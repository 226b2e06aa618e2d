"""Divergence audit against a plain version, spilled blocks, tiles and odd inputs."""

import re
from collections import Counter, defaultdict

import pytest

from tunestats.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string"


def plain(rows, min_docs, top):
    """The audit from whole tables of counts."""
    seen, docs, known = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        known[lang].add(source)
        seen[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, sources in known.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        whole = Counter()
        for s in sources:
            whole.update(seen[lang, s])

        def p(counts):
            n = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // n for t in kept}

        ps, q = {s: p(seen[lang, s]) for s in sources}, p(whole)
        for s in sources:
            f = lambda a, b: (a - b) ** 2 // (a + b)
            pairs = [(-sum(f(ps[s][t], ps[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(-f(ps[s][t], q[t]), t) for t in kept if seen[lang, s][t] and ps[s][t] > q[t]]
            out |= {(lang, s, "pair", o, -v, k) for k, (v, o) in enumerate(sorted(pairs, key=lambda x: (x[0], x[1].encode())), 1)}
            out |= {(lang, s, "term", t, -v, k) for k, (v, t) in enumerate(sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top], 1)}
    return out


def made():
    rows = []
    for i in range(240):
        vocabulary = ["Der", "die", "Ärger", "don't", "x1y", "ß", "日本", "Z", "the", "é" * (i % 3 + 1), f"rare{i}", "mid" + "abcde"[i % 5]]
        text = " ".join(vocabulary[(i * 7 + j * j) % len(vocabulary)] for j in range(i % 40))
        rows.append((i % 50, text, ["en", "de", None][i % 3], ["s1", "s2", None, "s4", "S5", "ä"][i * i % 6], "x"))
    rows += [(None, None, "fr", "alone", None), (None, "", "fr", "beside", None), (900, "the " * 3000 + "die", "en", "s1", None)]
    return rows + [(901, "the same text", "en", "copies", None)] * 60


@pytest.mark.parametrize("options", [{}, {"run_bytes": 2000, "tile": 2}])
def test_against_plain_version(spark, options):
    rows = made()
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA).repartition(4), min_docs=4, top=3, **options)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == plain(rows, 4, 3)


def test_counts_beyond_eight_bytes_times_scale():
    block = [{"source": "a", "n": 10**13}, {"source": "b", "n": 3}]
    sums = divergence.PairSums(7, block, block)
    sums.add([(["a", "b"], [10**13 - 5, 1])])
    p = 1 + 10**9 * (10**13 - 3) // (10**13 + 14)
    q = 1 + 10**9 * 3 // 17
    base = divergence.PairSums.apart(sums.p0[0][0], sums.p0[1][1])
    assert sums.sums[0, 1] + base == (p - q) ** 2 // (p + q)


def test_runs_are_sorted_and_merge_to_the_counts():
    blocks = [divergence.Block() for _ in range(3)]
    for i in range(300):
        blocks[i % 3].add("en", f"s{i % 4}", f"word{i % 17} Word{i % 5} tail".encode())
    pieces = defaultdict(list)
    for b in blocks:
        for row in b.spill(1):
            pieces[row["run"]].append(row["postings"])
    merged = list(divergence.merge(pieces))
    assert [t for t, *_ in merged] == sorted({t for t, *_ in merged})
    assert sum(n for _, n, _, _ in merged) == 900 and dict((t, d) for t, _, d, _ in merged)[b"tail"] == 300


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(divergence, "CUT", 10)
    text = "Ab,cd 日本語テキスト efghijklmnopqrstuvwxyz 12 x".encode()
    assert [w.decode() for part in divergence.words(text) for w in part] == ["ab", "cd", "日本語テキスト", "efghijklmnopqrstuvwxyz", "x"]
    assert list(divergence.words(b"")) == []


def test_empty_table_and_other_columns(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(1, "a b", "en", "s", "t")], SCHEMA).withColumnsRenamed({"term": "value"})
    assert divergence.audit(one).count() == 0


def test_block_memory_follows_new_terms():
    block = divergence.Block()
    block.add("en", "s", b"aa bb cc")
    first = block.bytes
    block.add("en", "s", b"aa bb cc aa")
    assert block.bytes == first == 3 * (divergence.TERM_BYTES + 2)
