"""Corpus cleaning: stages over the documents table, each written and read
again as Parquet in the shared folder before the next one runs.

Every stage works on all that the stage before it kept. The models of the
first stage and the proposals of the fourth are fitted on bounded samples (see
their modules); everything else covers all rows. All stages but the last
return the columns of ``documents``; the last adds token ids and the text that
they decode to.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunestats.llm import bpe, decontam, neardup, pii, quality
from tunestats.llm.shared import shared_root, stored
from tunestats.llm.spans import redact

SHINGLE = 5     # words in a shingle of the near-duplicate stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality.score_column(F.col("text"), model) >= 0.5)


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest id (any of
    those that share it; a row without an id only if none has one). Rows are
    told apart by a number of their own, which is written with them, so rows
    without an id and rows that repeat one are documents each."""
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "pipeline-rows")
    found = neardup.near_duplicates(rows.select("_row", "text"), id_col="_row", size=SHINGLE)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    first = rows.select("_row", "doc_id").join(found, "_row").groupBy("component_id").agg(F.min(place).alias("first"))
    return rows.join(first.select("first._row"), "_row", "left_semi").select(docs.columns)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = decontam.matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out_col="_items")
    return found.where(F.size("_items") == 0).drop("_items")


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; ``n_chars``, where the
    table has it, is that of the new text."""
    found = pii.scan(docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns}), pii.fit(docs), "in_text")
    value = {c: F.col(f"in_{c}") for c in docs.columns} | {"text": redact(F.col("in_text"), F.col("spans"))}
    if "n_chars" in value:
        kind = docs.schema["n_chars"].dataType
        value["n_chars"] = F.when(F.size("spans") > 0, F.length(value["text"]).cast(kind)).otherwise(F.col("in_n_chars"))
    return found.select(*(v.alias(c) for c, v in value.items()))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text that they decode to."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.decode(bpe.encode(docs, path), path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_duplicates", keep_first),
    ("decontamination", keep_uncontaminated),
    ("personal_data", hide_personal_data),
    ("tokens", tokenize),
]

#: DuckDB text of ``run``'s rows; the trained and hashed stages have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, in order."""
    root = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
