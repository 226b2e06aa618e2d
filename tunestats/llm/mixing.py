"""Mixing sources to target weights, in DataFrame operations alone.

The mix has a budget of words, a share of all words. ``water_fill`` gives each
source its weight's part of the budget; a source that would be read more often
than ``epochs`` times is clamped there, and what it leaves is dealt out again
among the others by weight, until none is above. Each round is one aggregate
over the table of sources and brings two numbers to the driver.

``draw`` turns a source's target into words taken from its documents: every
document is repeated as often as the target holds the whole source, and the
rest is sampled: documents in the order of a seeded digest of id and text are
taken until the rest is reached, the last of them in part (its first words).
So a source's taken words are its target, rounded to a word, and no document
is taken more than ``epochs`` times. The place where a source's sample ends is
found in three steps, by sums over ever finer ranges of the digest, so that no
task sorts a source: the first step sorts at most 4096 sums a source, the last
only rows that are equal in id and text and fall in one of 1024 cells.

Defined results: a null text has no words; a null source is a source of its
own, last in order; a null id counts as the empty text in the digest; repeated
rows are drawn each by itself (which of several equal rows is taken in part
does not show); sources without words have target 0; an empty table gives an
empty table; texts of any length are counted whole; names of results that the
input has already are refused with ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunestats.llm.shared import shared_root, stored
from tunestats.operators import numbered

WORD = r"[^\x20\x09-\x0D]++"     # fixed value: a word
WEIGHTS = (3, 1, 2)               # fixed values: weights of the sources in order, repeating
SHARE = 1.5                       # words of the mix, as a share of all words
EPOCHS = 2                        # times that a source is read at most
SEED = 13
HEAD = 3                          # hex digits of the digest that the first step of the search sums over
CELLS = 1024                      # cells over which rows of one digest are spread
RESULTS = ("size", "source_size", "target", "taken")
_HELPERS = ("_source", "_head", "_tail", "_cell", "_row")


def digest(id_col: Column, text: Column, seed: int) -> Column:
    """32 hex digits that order a source's documents."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))


def sized(docs: DataFrame, keep: Sequence[str], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          seed: int = SEED) -> DataFrame:
    """The columns ``keep`` of every document with its number of words and its
    place in the seeded order, as a table in the shared folder."""
    taken = {c.lower() for c in keep} & {c.lower() for c in (*RESULTS, *_HELPERS)}
    if taken:
        raise ValueError(f"the input already has the columns {sorted(taken)}")
    key = digest(F.col(id_col), F.col(text_col), seed)
    rows = docs.select(*keep, F.col(source_col).cast("string").alias("_source"),
                       F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       key.alias("_key"), F.monotonically_increasing_id().alias("_row"))
    return stored(rows.select(
        *keep, "_source", "size", F.substring("_key", 1, HEAD).alias("_head"), F.substring("_key", HEAD + 1, 32).alias("_tail"),
        F.pmod(F.xxhash64("_row"), F.lit(CELLS)).cast("int").alias("_cell"), "_row"), "mixing-sizes")


def weighed(rows: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """One row for each source: its words and its weight, which repeat over
    the sources by code point, null last."""
    sums = rows.groupBy("_source").agg(F.sum("size").alias("source_size"))
    placed = numbered(sums, [F.asc_nulls_last("_source")], shared_root(rows.sparkSession), "_place")
    return stored(placed.select("_source", "source_size", F.get(
        F.array(*map(F.lit, weights)), ((F.col("_place") - 1) % len(weights)).cast("int")).alias("weight")), "mixing-sources")


def water_fill(sources: DataFrame, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``sources`` (source_size, weight) with each one's target of words.

    ``level`` is the words a unit of weight gets; it rises until no further
    source is above its cap, at the latest after as many rounds as there are
    sources."""
    cap, weight = epochs * F.col("source_size"), F.col("weight")
    row = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget, level = share * (row["size"] or 0), 0.0
    fixed, rest = 0, row["weight"]
    while rest and (risen := (budget - fixed) / rest) > level:
        level = risen
        over = cap < level * weight
        row = sources.agg(F.sum(F.when(over, cap)).alias("fixed"), F.sum(F.when(~over, weight)).alias("rest")).first()
        fixed, rest = row["fixed"] or 0, row["rest"]
    # without a rest every source is at its cap (a budget of all caps or more)
    target = F.least(cap.cast("double"), F.lit(level) * weight) if rest else cap.cast("double")
    return sources.withColumn("target", target)


def ends(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """For each source: ``goal`` (its target in whole words), ``whole``
    repetitions, and where the sample of the rest ends: the cell (_head, _tail,
    _cell) and the words still missing before that cell."""
    goal = F.floor(F.col("target") + 0.5)
    at = stored(sources.select(
        "_source", "source_size", "target", F.coalesce(F.try_divide(goal, F.col("source_size")).cast("long"), F.lit(0)).alias("whole"))
        .withColumn("missing", goal - F.col("whole") * F.col("source_size")), "mixing-ends")
    found: list[str] = []
    for step in ("_head", "_tail", "_cell"):
        same = rows["_source"].eqNullSafe(at["_source"])
        for name in found:
            same &= rows[name] == at[f"end{name}"]
        sums = rows.join(at, same).groupBy(at["_source"], "missing", rows[step]).agg(F.sum("size").alias("size"))
        before = Window.partitionBy("_source").orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("_before", F.coalesce(F.sum("size").over(before), F.lit(0)))
        cut = sums.where((F.col("_before") <= F.col("missing")) & (F.col("missing") < F.col("_before") + F.col("size"))).select(
            F.col("_source").alias("_of"), F.col(step).alias(f"end{step}"), (F.col("missing") - F.col("_before")).alias("_left"))
        at = stored(at.join(cut, at["_source"].eqNullSafe(cut["_of"]), "left").withColumn(
            "missing", F.coalesce("_left", "missing")).drop("_of", "_left"), "mixing-ends")
        found.append(step)
    return at


def draw(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with source_size, target and taken."""
    keep = [c for c in rows.columns if c not in _HELPERS and c != "size"]
    at = ends(rows, sources).withColumnRenamed("_source", "_of")
    place = F.struct("_head", "_tail", "_cell")
    end = F.struct(*(F.col(f"end{c}").alias(c) for c in ("_head", "_tail", "_cell")))
    # a source without words has no end: none of its rows has anything to take
    all_rows = rows.join(at, rows["_source"].eqNullSafe(at["_of"])).withColumn("_at_end", F.coalesce(place == end, F.lit(False)))
    size = F.col("size")
    whole = all_rows.where(~F.col("_at_end")).withColumn("_more", F.when(place < end, size).otherwise(0))
    before = Window.partitionBy("_source").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    part = all_rows.where("_at_end").withColumn("_more", F.greatest(F.lit(0), F.least(
        size, F.col("missing") - F.coalesce(F.sum("size").over(before), F.lit(0)))))
    return whole.unionByName(part).select(
        *keep, "size", "source_size", "target", (F.col("whole") * size + F.col("_more")).cast("long").alias("taken"))


def mix(docs: DataFrame, keep: Sequence[str] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """The columns ``keep`` (all by default) of every document with ``RESULTS``."""
    rows = sized(docs, docs.columns if keep is None else keep, id_col, text_col, source_col, seed)
    return draw(rows, water_fill(weighed(rows, weights), share, epochs))


def copies(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """The texts of the mix: each document once for every repetition, the
    last cut after the words still to be taken."""
    size, taken = F.col("size"), F.col("taken")
    times = F.when(size > 0, F.ceil(taken / size).cast("int")).otherwise(0)
    rows = mixed.where(times > 0).select("*", F.explode(F.sequence(F.lit(1), times)).alias("repetition"))
    words = F.least(size, taken - (F.col("repetition") - 1) * size)
    cut = F.array_join(F.slice(F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0)), F.lit(1), words.cast("int")), " ")
    return rows.withColumn(text_col, F.when(words < size, cut).otherwise(F.col(text_col)))
