"""Bounded samples of rows for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = 1 << 31


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds`` (null for a null id)."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def place(id_col: Column) -> Column:
    """A place in [0, SPACE) that depends on the id alone."""
    return F.pmod(F.xxhash64(id_col), F.lit(SPACE))


def about(df: DataFrame, id_col: str, rows: int, *keep: str) -> DataFrame:
    """The columns ``keep`` of around ``rows`` rows of ``df``, one for each of as
    many ids, which are chosen by their hash; all ids when there are no more.

    Of the rows that share an id the one with the least hash of ``keep`` stays,
    so however many rows repeat an id, inside the sample or outside, the
    sample has no more rows than ids. Rows without an id are left out. The ids
    are counted, and the rows of one id combined in each task before any
    shuffle; nothing is sorted or gathered."""
    known = df.where(F.col(id_col).isNotNull())
    total = known.select(id_col).distinct().count()
    if total > rows:
        known = known.where(place(F.col(id_col)) < int(SPACE * rows / total))
    one = known.groupBy(id_col).agg(F.min_by(F.struct(*keep), F.struct(F.xxhash64(*keep), *keep)).alias("_one"))
    return one.select(F.col(id_col), *(F.col("_one")[c].alias(c) for c in keep if c != id_col))


def block_of(text: Column, chars: int) -> Column:
    """The text, or of a longer one ``chars`` characters in a row from a place
    that its hash gives."""
    begin = F.pmod(F.xxhash64(text), F.length(text) - chars + 1) + 1
    return F.when(F.length(text) <= chars, text).otherwise(F.substr(text, begin.cast("int"), F.lit(chars)))
