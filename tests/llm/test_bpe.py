"""BPE against the tokenizers library, and merges against a plain scan."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from tunestats.llm import bpe, registry

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)
OWN = bpe.load(PATH)


def scan_merge(symbols, ranks):
    symbols = list(symbols)
    while True:
        best = min(((ranks[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks), default=None)
        if best is None:
            return symbols
        i = best[1]
        symbols[i:i + 2] = [ranks[symbols[i], symbols[i + 1]][1]]


def test_segment_tree_equals_scan():
    rng = random.Random(5)
    for _ in range(400):
        ranks, nxt = {}, 4
        for r in range(rng.randint(0, 12)):
            pair = (rng.randrange(nxt), rng.randrange(nxt))
            if pair not in ranks:
                ranks[pair] = (r, nxt)
                nxt += 1
        symbols = [rng.randrange(4) for _ in range(rng.randint(0, 40))]
        want = scan_merge(symbols, ranks)
        assert bpe.merge_symbols(symbols, ranks) == want
        if ranks and symbols:
            rows = np.full((3, 41), -1)
            rows[1, :len(symbols)], rows[2, :len(symbols) // 2] = symbols, symbols[:len(symbols) // 2]
            got = bpe.Merges(ranks).rows(rows)
            assert got[1][got[1] >= 0].tolist() == want and (got[0] == -1).all()
            assert got[2][got[2] >= 0].tolist() == scan_merge(symbols[:len(symbols) // 2], ranks)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abc'sStT 12éÉßΣς\n\t\x85\xa0 İı'<|>😀日"), st.characters(exclude_categories=["Cs", "Cn"], max_codepoint=0x2FFF))))
def test_library_random(text):
    want = LIB.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == want
    assert OWN.decode(want) == LIB.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["", " ", "x" * 5000, "ab" * 3000 + " don't we'll", "a<|endoftext|>B <|startoftext|>",
                                  "<|endoftext", "İΣ ΑΣ ſ", "é 가"])
def test_library_edges(text):
    want = LIB.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == want
    assert OWN.decode(want) == LIB.decode(want, skip_special_tokens=False)


def test_null_empty_repeats_and_clashes(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (None, "Hi hi", None), (2, "", "y")],
                               "doc_id long, text string, extra string")
    got = bpe.decode(bpe.encode(df, PATH), PATH).orderBy(F.col("doc_id").asc_nulls_last()).collect()
    assert [r.ids for r in got][:3] == [[], [], []] and got[3].decoded == "hi</w> hi</w>" and got[0].extra == "x"
    with pytest.raises(ValueError):
        bpe.encode(df.withColumnRenamed("extra", "IDS"), PATH)
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_query_whole_table(spark):
    import hashlib
    got = {r.doc_id: r for r in registry.op1_bpe(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = LIB.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIB.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_tables_start_afresh(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_CACHED", 20)
    monkeypatch.setattr(bpe, "PART_CHARS", 50)
    own = bpe.WordBpe(PATH)
    texts = [f"word{i} other{i % 7}, and more{i // 3}!" for i in range(60)] + [None]
    assert [x.tolist() for x in own.encode_many(texts)] == [LIB.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_decode_leaves_unknown_ids_out(spark):
    df = spark.createDataFrame([(1, [320, -5, 10 ** 6, None, 320]), (2, None), (3, [])], "k int, ids array<int>")
    a = LIB.decode([320, 320], skip_special_tokens=False)
    assert [r.decoded for r in bpe.decode(df, PATH).orderBy("k").collect()] == [a, "", ""]


def test_tables_that_turn_over_change_no_ids(monkeypatch):
    import random

    path = public_tokenizers.path("word_bpe_49k.json")
    draw = random.Random(5)
    texts = [" ".join(draw.choice(["the", "don't", "naïve", "x" * draw.randrange(1, 90), f"w{draw.randrange(300)}", "日本語", "a.b,c"])
                      for _ in range(draw.randrange(60))) for _ in range(200)]
    whole = [x.tolist() for x in bpe.WordBpe(path).encode_many(texts)]
    for cached, letters, symbols, part in ((3, 1 << 20, 1, 64), (40, 1 << 20, 64, 500), (1 << 20, 50, 1 << 17, 300)):
        monkeypatch.setattr(bpe, "MAX_CACHED", cached)
        monkeypatch.setattr(bpe, "MAX_LETTERS", letters)
        monkeypatch.setattr(bpe, "ROWS_SYMBOLS", symbols)
        monkeypatch.setattr(bpe, "PART_CHARS", part)
        small = bpe.WordBpe(path)
        assert [x.tolist() for x in small.encode_many(texts)] == whole
        assert small.older[0]
