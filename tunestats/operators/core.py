"""Relational building blocks used by the table builders.

All of them are compositions of DataFrame operators; none collects data to
the driver. Where an operator needs a size decision (broadcast or not) it
compares the bytes in memory with a bound.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from tunestats.functions import typed_null

# Bound in bytes for broadcasting a star-join dimension (see
# ``left_join_dim``): the size in memory of the joined columns, all
# widths included. It must stay well below the driver's result size
# (``spark.driver.maxResultSize``, 1g by default), through which a broadcast
# passes. The session setting ``tunestats.broadcast.maxBytes`` changes it
# (read by ``broadcast_bound``).
BROADCAST_MAX_BYTES = 256 << 20
BROADCAST_CONF = "tunestats.broadcast.maxBytes"
# Bytes in memory for each byte of a compressed file: what the optimizer's
# estimate (the files' size, by the share of the columns read) is multiplied by.
EXPANSION = 4
# Bytes of a broadcast relation for each row beside its values: the key's and the
# row's headers, and the slot in the hash table (half of it at most is in use).
RELATION_ROW = 80
# Parts that a dimension beyond the bound is broadcast in, one after the other, at most.
MAX_PARTS = 16


def broadcast_bound(spark) -> int:
    """The session's dimension broadcast bound in bytes (``-1`` disables
    explicit broadcasts)."""
    return int(spark.conf.get(BROADCAST_CONF, str(BROADCAST_MAX_BYTES)))


# --------------------------------------------------------------------------
# Projection / conformance (PRJ-1, PRJ-2, PRJ-3, PRJ-5)
# --------------------------------------------------------------------------
def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: same names, same order, cast to the
    declared types; columns absent from ``df`` become typed NULLs; extra
    columns are dropped."""
    present = set(df.columns)
    cols = [
        (F.col(f.name).cast(f.dataType) if f.name in present else typed_null(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*cols)


def add_missing(df: DataFrame, name: str, data_type) -> DataFrame:
    """PRJ-3: add ``name`` as a typed NULL column if ``df`` lacks it."""
    return df if name in df.columns else df.withColumn(name, typed_null(data_type))


# --------------------------------------------------------------------------
# Distinct / de-duplication (DST-1, DST-2)
# --------------------------------------------------------------------------
def distinct_rows(df: DataFrame) -> DataFrame:
    """DST-1."""
    return df.distinct()


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """DST-2: one row per key; NULL keys collapse into one row.

    The survivor is deterministic: the smallest row by ``order`` (default:
    the non-key columns in table order), ascending, NULLs first. It is chosen
    with ``min(struct(...))`` in a grouped aggregate, so Spark combines
    duplicates map-side before the shuffle: a key holding a third of all rows
    is reduced to one row per input partition, never sorted as one group.
    """
    keys = list(keys)
    rest = [c for c in (order or df.columns) if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    survivor = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_survivor"))
    return survivor.select(*keys, *[F.col("_survivor").getField(c).alias(c) for c in rest]).select(*df.columns)


# --------------------------------------------------------------------------
# Sorting and top-k (SRT-*, TOP-*)
# --------------------------------------------------------------------------
def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """TOP-2/3/4: ``ORDER BY … LIMIT n``. Spark plans it as a per-partition
    top-n followed by a merge of n rows per partition (TakeOrderedAndProject):
    no global sort of the input."""
    return df.orderBy(*order).limit(n)


def top1_by_count(df: DataFrame, group_col: str, alias: str, count_alias: str = "plays") -> DataFrame:
    """TOP-1: the ``group_col`` value with the most rows (NULL is a value).

    Ties are broken by the value ascending with NULL last, so reruns agree.
    The count is a hash aggregate with map-side partial counts, so a hot
    value costs one counter per partition.
    """
    counts = df.groupBy(F.col(group_col).alias(alias)).agg(F.count(F.lit(1)).alias(count_alias))
    return top_n(counts, [F.desc(count_alias), F.asc_nulls_last(alias)], 1)


# --------------------------------------------------------------------------
# Arrays to rows (ARR-1)
# --------------------------------------------------------------------------
def explode_genres(df: DataFrame, keep: Iterable[str], array_col: str = "genres", out: str = "genre") -> DataFrame:
    """ARR-1: inner explode: NULL or empty arrays drop the row; a row with n
    elements yields n rows; NULL elements survive (filter them afterwards)."""
    return df.select(*keep, F.explode(F.col(array_col)).alias(out))


# --------------------------------------------------------------------------
# Joins (JN-1, JN-2)
# --------------------------------------------------------------------------
def estimated_bytes(df: DataFrame) -> int:
    """Estimated size of ``df`` in memory: the optimizer's estimate, which for
    a stored table is the size of its files by the share of the columns read,
    times ``EXPANSION``. No job runs. Without statistics (a join of unknown
    size) the estimate is huge, so such a frame is never broadcast by it."""
    return EXPANSION * int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` as a broadcast relation, from its rows and the widths of
    its values (one aggregate over ``df``). Files do not tell it: a catalogue of
    short, repeated texts takes 60 times its files."""
    width = F.lit(RELATION_ROW + 8 * (len(df.columns) + 2))
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(c) + 7, F.lit(0))
        elif isinstance(kind, (ArrayType, MapType, StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(c)) * 3 + 32, F.lit(0))
    return int(df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0])


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` takes at most ``max_bytes`` in memory. The optimizer's estimate
    can only rule it out; what it lets through is measured."""
    return estimated_bytes(df) <= max_bytes and measured_bytes(df) <= max_bytes


def unless_large(dim: DataFrame, max_bytes: int | None) -> DataFrame:
    """``dim`` for a join that is left to the optimizer, which goes by the files: where
    they are small and what is in them is beyond the bound, both sides are sorted."""
    if max_bytes is None or max_bytes < 0 or estimated_bytes(dim) > max_bytes or measured_bytes(dim) <= max_bytes:
        return dim
    return dim.hint("merge")


def broadcast_parts(dim: DataFrame, max_bytes: int | None) -> int:
    """How many parts of ``dim``, each of half the bound at most, a join can broadcast
    one after the other (``in_part``): 1 where the whole fits, and where it would be
    more than ``MAX_PARTS``, as that often reading the fact costs more than dealing it out."""
    if max_bytes is None or max_bytes <= 0 or estimated_bytes(dim) > max_bytes:
        return 1
    size = measured_bytes(dim)
    parts = 1 if size <= max_bytes else -(-size // max(1, max_bytes // 2))
    return parts if parts <= MAX_PARTS else 1


def in_part(key: str, part: int, parts: int) -> Column:
    """Whether a row's key (NULL is one) falls into this one of the ``parts``."""
    return F.pmod(F.xxhash64(key), F.lit(parts)) == part


def left_join_dim(fact: DataFrame, dim: DataFrame, on: str,
                  broadcast_max_bytes: int | None = BROADCAST_MAX_BYTES) -> DataFrame:
    """Left equi-join of a fact to a dimension that is unique on ``on``.

    Row-preserving: every fact row appears once. ``on`` is taken from the
    dimension, so it is NULL for unmatched fact rows.

    Strategy: a dimension whose bytes in memory (see ``fits_broadcast``) are
    within the bound is broadcast, so the fact stays where it is (no fact
    shuffle, no skew exposure) and the dimension is always the build side,
    even where a later ``key IS NOT NULL`` filter lets the optimizer turn the
    left join into an inner one. Beyond the bound both sides are
    hash-partitioned on the key (sort-merge join); a hot key, including the
    NULL key of unmatched plays, lands in one reducer partition, which
    adaptive execution splits across tasks (fact side of a left outer join;
    see ``session.SCALE_CONF``). Building the plan runs one aggregate over a
    dimension whose estimate is within the bound. One that then turns out larger is
    not left to the optimizer, which would broadcast it for its small files.

    The split needs a plain shuffle on both sides, which is what a stored
    dimension table gets; the pipeline therefore joins the stored silver
    tables (a dimension de-duplicated in the same query would hand its own
    partitioning to the join instead).

    ``broadcast_max_bytes=None`` leaves the choice to the optimizer.
    """
    key = "_dim_key"
    d = dim.select(F.col(on).alias(key), *dim.columns)
    if broadcast_max_bytes is not None and broadcast_max_bytes >= 0 and estimated_bytes(dim) <= broadcast_max_bytes:
        d = F.broadcast(d) if measured_bytes(dim) <= broadcast_max_bytes else d.hint("merge")
    f = fact.withColumnRenamed(on, key)
    return f.join(d, on=key, how="left").drop(key)


# --------------------------------------------------------------------------
# Combining one-row relations (JN-4)
# --------------------------------------------------------------------------
def stitch_rows(parts: Sequence[DataFrame], schema: StructType) -> DataFrame:
    """Combine relations of at most one row each into one row.

    Equivalent to a cross product of the parts (so the result is empty when
    any part is empty) but planned as a union and a global aggregate: there
    is no join, and each part contributes only its own columns. Every column
    of ``schema`` must come from exactly one part.
    """
    owner: dict[str, int] = {}
    tagged = []
    for i, p in enumerate(parts):
        for c in p.columns:
            owner[c] = i
        cols = [(F.col(f.name) if f.name in p.columns else typed_null(f.dataType)).alias(f.name)
                for f in schema.fields]
        tagged.append(p.select(F.lit(i).alias("_part"), *cols))
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionByName(t)
    aggs = [F.max(F.when(F.col("_part") == owner[f.name], F.col(f.name))).alias(f.name) for f in schema.fields]
    out = u.agg(F.count_distinct("_part").alias("_n_parts"), *aggs)
    return out.where(F.col("_n_parts") == len(parts)).select(*schema.fieldNames())
