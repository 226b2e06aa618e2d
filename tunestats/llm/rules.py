"""Quality rules as a short-circuit cascade, in DataFrame operations alone.

``metrics`` counts words, word characters, symbols, repeated lines and words
in repeated three-word windows of every whole text. ``Rule``s are conditions
over the text and its words; ``order_rules`` measures each rule's cost and the
share that it rejects on a sample, and puts the rules with most rejections per
second first; ``cascade`` evaluates them in that order and stops at the first
that rejects. The order changes the work, never the verdict.

Defined results: a null text has no words and no lines; the empty text and
white space alone likewise; equal lines count from the second on; a text with
fewer than three words has no repeated window; repeated rows get equal
results; the input's columns are kept, and names of results that it has
already are refused with ``ValueError``; rules on an empty table keep their
given order.
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunestats.llm.sampling import about

SPACES = r"[\x20\x09-\x0D]+"          # fixed value: what parts words
SPACE_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"                   # fixed value: characters that count as symbols
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SAMPLE_ROWS = 1000
REPEATS, RUNS = 10, 3      # times that the sample is evaluated in a job, and jobs for each rule


@dataclass(frozen=True)
class Rule:
    """A text passes while ``rejects`` is not true."""

    name: str
    rejects: Column


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def default_rules(text: Column, w: Column) -> list[Rule]:
    """Rules over the text and its words ``w``."""
    n = F.size(w)
    whole = F.coalesce(text, F.lit(""))
    chars = F.length(without(whole, SPACE_CHARS))
    upper, lower = F.length(F.regexp_replace(whole, r"[^\p{Lu}]+", "")), F.length(F.regexp_replace(whole, r"[^\p{Ll}]+", ""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE_CHARS))) > 0)
    return [
        Rule("word_length", (chars > 15 * n) | (2 * chars < 4 * n)),
        Rule("symbols", 10 * (F.length(whole) - F.length(without(whole, SYMBOLS))) > 5 * n),
        Rule("shouting", upper > lower),
        Rule("letters", 10 * F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))) < 7 * n),
        Rule("bullets", 10 * F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\t]*[-•*]"))) > 9 * F.size(lines)),
        Rule("ellipses", 10 * F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\t\r]*$"))) > 3 * F.size(lines)),
        Rule("few_distinct", 10 * F.size(F.array_distinct(w)) < n),
    ]


def _free(df: DataFrame, names: Sequence[str]) -> None:
    taken = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if taken:
        raise ValueError(f"the input already has the columns {sorted(taken)}")


def metrics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the counts ``METRICS`` and the helper column ``_words``."""
    _free(df, (*METRICS, "_words", "_lines", "_marks", "_sorted", "_places"))
    given = [F.col(c) for c in df.columns]
    text = F.coalesce(F.col(text_col), F.lit(""))
    # each step's array is a column of its own, made once for each row
    step = df.select(*given, words(F.col(text_col)).alias("_words"),
                     F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE_CHARS))) > 0).alias("_lines"))
    w, n = F.col("_words"), F.size("_words")
    step = step.select(*given, "_words", "_lines", F.when(n >= 3, F.transform(
        F.slice(w, 1, F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))).alias("_marks"))
    marks = F.col("_marks")
    step = step.select(*given, "_words", "_lines", F.when(
        F.size(F.array_distinct(marks)) < F.size(marks),
        F.sort_array(F.transform(marks, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_sorted"))
    m, s = F.size("_sorted"), F.col("_sorted")
    step = step.select(*given, "_words", "_lines", F.when(s.isNotNull(), F.sort_array(F.array_distinct(F.flatten(F.zip_with(
        F.slice(s, 1, m - 1), F.slice(s, 2, m - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))))).alias("_places"))
    p, k = F.col("_places"), F.size("_places")
    covered = F.when(p.isNull() | (k <= 0), F.lit(0)).otherwise(F.lit(3) + F.aggregate(
        F.zip_with(F.slice(p, 2, k), F.slice(p, 1, F.greatest(k - 1, F.lit(0))), lambda b, a: F.least(b - a, F.lit(3))),
        F.lit(0), lambda t, x: t + F.coalesce(x, F.lit(0))))
    return step.select(
        *given, "_words", n.cast("long").alias("n_words"), F.length(without(text, SPACE_CHARS)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"))


def order_rules(df: DataFrame, rules: Sequence[Rule], id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second on a sample of about
    ``sample_rows`` rows; ties keep their given order. A rule's time is the
    least of ``RUNS`` jobs over the sample's rows ``REPEATS`` times, less that of
    the same job without a rule."""
    sample = about(df, id_col, sample_rows, *(c for c in df.columns if c != id_col)).persist()
    try:
        rows = sample.count()
        if not rows:
            return list(rules)
        repeated = sample.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

        def timed(condition: Column) -> tuple[float, int]:
            least, n = math.inf, 0
            for _ in range(RUNS):
                began = time.perf_counter()
                n = repeated.agg(F.count_if(condition).alias("n")).first()["n"]
                least = min(least, time.perf_counter() - began)
            return least, n

        timed(rules[0].rejects)                            # warms the sample up
        empty, _ = timed(F.col("_again") < 0)
        gain = {}
        for rule in rules:
            seconds, rejected = timed(rule.rejects)
            gain[rule.name] = rejected / max(seconds - empty, empty / 10)
        return sorted(rules, key=lambda r: -gain[r.name])
    finally:
        sample.unpersist()


def cascade(rules: Sequence[Rule]) -> Column:
    """True if no rule rejects; later rules are not evaluated once one does."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(rule.rejects, F.lit(False)).otherwise(verdict)
    return verdict


def judge(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``df`` with ``METRICS``, ``base_failed`` and ``kept``."""
    _free(df, (*METRICS, "_words", "base_failed", "kept"))
    sample = df.select(F.col(id_col), F.col(text_col).alias("_text"), words(F.col(text_col)).alias("_words"))
    ordered = order_rules(sample, default_rules(F.col("_text"), F.col("_words")), id_col, sample_rows)
    here = {r.name: r for r in default_rules(F.col(text_col), F.col("_words"))}
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return metrics(df, text_col).withColumn("base_failed", base).withColumn(
        "kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade([here[r.name] for r in ordered]))).drop("_words")
