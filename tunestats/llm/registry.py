"""The queries of this subpackage and, where SQL can express one, its DuckDB text."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunestats.llm import bpe, decontam, divergence, langid, lmscore, mixing, neardup, negatives, oracle, pii, quality, rules, secrets, warc
from tunestats.llm.sampling import fold
from tunestats.llm.shared import shared_root
from tunestats.llm.spans import told


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(docs, path), path)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document, learned outside fold 1 of 3."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(fold(F.col("doc_id"), 3) != 1))
    return quality.score(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.scan(docs, pii.fit(docs)).select("doc_id", "base_spans", "spans")
    return found.select("doc_id", *(_count("base_spans", k) for k in ("email", "ip", "card", "phone")),
                        F.sha2(told(F.col("base_spans")), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, with the items found."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.matches(docs, _table(spark, sf_dir, "benchmark")).where(F.size("matches") > 0)
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back from the archives."""
    folder = f"{shared_root(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(_table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder, payloads=False).select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"), "digest_ok")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = secrets.scan(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "base_spans", "spans")
    return found.select("doc_id", *(_count("base_spans", k) for k in ("assign", "access", "hex")),
                        F.sha2(told(F.col("base_spans")), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similar sets of four-word shingles."""
    found = neardup.near_duplicates(_table(spark, sf_dir, "documents"), size=4)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and the cascade's verdict."""
    judged = rules.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *rules.METRICS, "base_failed", "kept")


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned outside fold 2 of 4."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(fold(F.col("doc_id"), 4) != 2))
    return langid.predict(docs.drop("lang"), model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(True)).alias("held_out"),
        F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"),
        F.col("language.rejected").alias("rejected"))


def op10_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pseudo log-likelihood of every document under a network trained on
    all of them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = lmscore.stored(lmscore.word_counts(docs))
    vocab = lmscore.most_frequent(counts)
    flat = lmscore.train(docs, vocab, counts=counts)
    scored = lmscore.score(docs, vocab, flat, counts=counts, keep=["doc_id"]).select("doc_id", "lm.n_tokens", "lm.log_prob")
    return scored.withColumn("mean_log_prob", F.try_divide("log_prob", "n_tokens"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every hundredth vector and its positives."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.prepared(_table(spark, sf_dir, "embeddings"), label=moved)
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far apart the sources of a language are, and by which terms."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of the sources takes of every document."""
    return mixing.mix(_table(spark, sf_dir, "documents"), keep=["doc_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_quality": op2_quality,
    "op3_pii": op3_pii,
    "op4_decontam": op4_decontam,
    "op5_warc": op5_warc,
    "op6_secrets": op6_secrets,
    "op7_minhash": op7_minhash,
    "op8_rules": op8_rules,
    "op9_langid": op9_langid,
    "op10_lmscore": op10_lmscore,
    "op11_negatives": op11_negatives,
    "op12_divergence": op12_divergence,
    "op13_mixing": op13_mixing,
}

SQL: dict[str, str] = dict(oracle.STATEMENTS)
