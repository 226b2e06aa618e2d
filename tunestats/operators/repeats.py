"""De-duplication that leaves alone what occurs once.

``dedupe`` sends every row through a grouped minimum of a struct, which Spark
can only do by sorting. Where most keys occur once, that is work for nothing.
``dedupe_repeats`` first counts a 64-bit hash of the key: fixed-width buffers, so a
hash aggregate, and only the hash is shuffled. The hashes that occur again set
bits of a filter of bounded size; rows whose bit is not set occur once and stay
where they are, and only the others go through ``dedupe``. A key that shares a
bit with a repeated one is sent there too and comes out as it was, so neither
hash collisions nor a crowded filter change the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunestats.operators.core import broadcast_bound, dedupe

BITMAP_BITS = 1 << 15      # fixed value: bits of one bitmap of Spark's bitmap functions
BITS_A_KEY = 16            # bits of the filter for each repeated hash: 6 % of the other rows take the long way
MAX_BITS = 1 << 30         # bits of the filter at most (128 MB), whatever the number of keys


def _place(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def _is_set(bitmap: Column, place: Column) -> Column:
    """Whether bit ``place`` (within the bitmap) is 1."""
    byte = F.conv(F.hex(F.substring(bitmap, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, (place % 8).cast("int")) == 1


def split_repeats(df: DataFrame, keys: Sequence[str], root: str) -> tuple[DataFrame, DataFrame | None]:
    """(rows whose key occurs once, rows whose key may occur again); the
    second is ``None`` if no key does. Reads the key columns of ``df`` once, and
    ``df`` once for either part; the repeated hashes and the filter are written
    to the folder ``root``."""
    spark, folder = df.sparkSession, f"{root}/repeats-{uuid.uuid4().hex}"
    again = df.select(F.xxhash64(*keys).alias("h")).groupBy("h").count().where("count > 1").select("h")
    again.write.parquet(f"{folder}/again")
    again = spark.read.parquet(f"{folder}/again")
    n = again.count()
    if not n:
        return df, None
    room = min(MAX_BITS, 8 * max(broadcast_bound(spark), BITMAP_BITS // 8))
    bits = BITMAP_BITS
    while bits < min(BITS_A_KEY * n, room // 2 + 1):
        bits *= 2
    place = F.pmod("h", F.lit(bits))
    (again.groupBy(F.floor(place / BITMAP_BITS).alias("_bitmap")).agg(F.bitmap_construct_agg(place % BITMAP_BITS).alias("_bits"))
     .write.parquet(f"{folder}/filter"))
    # at most bits / 8 bytes, which is within the session's broadcast bound
    marks = F.broadcast(spark.read.parquet(f"{folder}/filter"))
    at = _place(keys, bits)
    marked = df.withColumn("_at", at).join(marks, F.floor(F.col("_at") / BITMAP_BITS) == F.col("_bitmap"), "left").withColumn(
        "_again", F.coalesce(_is_set(F.col("_bits"), F.col("_at") % BITMAP_BITS), F.lit(False)))
    return marked.where(~F.col("_again")).select(*df.columns), marked.where("_again").select(*df.columns)


def dedupe_repeats(df: DataFrame, keys: Sequence[str], root: str, order: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``dedupe(df, keys, order)``, without sorting rows whose key
    occurs once. Runs two jobs over the key columns when called."""
    once, repeated = split_repeats(df, keys, root)
    return once if repeated is None else once.unionByName(dedupe(repeated, keys, order))
