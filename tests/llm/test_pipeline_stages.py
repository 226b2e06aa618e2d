"""The pipeline, stage by stage, against plain versions of each."""

import tempfile

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from conftest import SF_SMALL
from test_decontam import exact_places
from test_neardup import plain_components
from test_spans import plain_pii
from tunestats.llm import quality

LIB = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def kept(spark):
    """What every stage returns."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    out.append(docs)
    for _, stage in cp.STAGES:
        path = tempfile.mkdtemp(prefix="stage-") + "/t"
        stage(spark, out[-1], SF_SMALL).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [(d.columns, {r.doc_id: r for r in d.collect()}) for d in out]


def test_columns_and_order(kept):
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "tokens"]
    assert all(set(c) == set(kept[0][0]) for c, _ in kept[:-1])
    assert all(later.keys() <= earlier.keys() for (_, earlier), (_, later) in zip(kept, kept[1:]))
    assert len(kept[2][1]) < len(kept[1][1]) < len(kept[0][1])


def test_quality_stage(spark, kept):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    assert {i for i, r in kept[0][1].items() if model.scores([r.text])[0] >= 0.5} == kept[1][1].keys()


def test_near_duplicate_stage(kept):
    rows = [(i, r.text) for i, r in kept[1][1].items()]
    assert {i for i, _, c in plain_components(rows, 5) if i == c} == kept[2][1].keys()


def test_decontamination_stage(spark, kept):
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    gone = kept[2][1].keys() - kept[3][1].keys()
    assert gone and {i for i, r in kept[2][1].items() if any(exact_places(r.text, t) for t in items)} <= gone
    assert all(kept[3][1][i].text == r.text for i, r in kept[2][1].items() if i not in gone)


def test_personal_data_stage(kept):
    before, after = kept[3][1], kept[4][1]
    assert before.keys() == after.keys()
    for i, r in before.items():
        spans = plain_pii(r.text)
        if not spans and "[NUMBER]" not in after[i].text and "[DOTTED]" not in after[i].text:
            assert after[i].text == r.text or "[" in after[i].text
        for kind, a, b in spans:
            assert r.text[a:b] not in after[i].text or kind == "ip"
        assert after[i].n_chars == len(after[i].text)


def test_token_stage(kept):
    for i, r in kept[5][1].items():
        ids = LIB.encode(kept[4][1][i].text, add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == LIB.decode(ids, skip_special_tokens=False)


def test_run_and_hard_rows(spark, kept):
    assert {r.doc_id for r in cp.run(spark, SF_SMALL).select("doc_id").collect()} == kept[5][1].keys()
    rows = [(1, None, None, "s", 0), (None, "mail a@b.de " + "word " * 30_000, "en", None, 3), (2, "", "en", "s", None), (2, "", "en", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("key", docs_key())
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert sorted(out.columns) == sorted(docs.columns)
        out.collect()
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
    assert cp.tokenize(spark, docs, SF_SMALL).count() == 4


def docs_key():
    from pyspark.sql import functions as F
    return F.lit(7)


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    base = [" ".join(f"{w}{i}" for i in range(60)) for w in "abcde"]
    near = [t.replace("30", "other", 1) for t in base]
    rows = [(None, base[0]), (None, base[0]), (None, near[0]), (4, base[1]), (4, base[1]), (4, base[2]), (3, near[2]), (None, base[3]), (9, near[3]),
            (5, base[4]), (5, "unlike all others " + "z " * 9), (None, None), (None, None), (6, ""), (6, "")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = sorted((str(r.doc_id), r.text or "") for r in cp.keep_first(spark, docs, SF_SMALL).collect())
    texts = [t for _, t in got]
    assert sum(t in (base[0], near[0]) for t in texts) == 1 and ("None", base[0]) in got or ("None", near[0]) in got
    assert [g for g in got if g[1] in (base[1],)] == [("4", base[1])]
    assert [g for g in got if g[1] in (base[2], near[2])] == [("3", near[2])]
    assert [g for g in got if g[1] in (base[3], near[3])] == [("9", near[3])]          # an id before none
    assert ("5", base[4]) in got and any(t.startswith("unlike") for t in texts)
    assert sum(t == "" for t in texts) == 4 and len(got) == 10
