"""Consecutive numbers over a whole table without a window over all its rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROW_BITS = 33      # fixed value: monotonically_increasing_id keeps the row within its partition in so many low bits


def in_order(df: DataFrame, root: str, name: str = "position") -> DataFrame:
    """``df`` with the place of each row, from 1, in the order that it comes
    in: that of its partitions, and of the rows in each.

    Nothing is sorted here: a frame that is in no order gets its rows' places
    as they lie. Partition and place in it are written with the rows to the
    folder ``root``. The rows before a partition are the prefix sum of the
    partitions' row counts; that table has one row for each partition of the
    write, which bounds its broadcast and the one window over it."""
    taken = {c.lower() for c in df.columns} & {name.lower(), "_part", "_row"}
    if taken:
        raise ValueError(f"the input already has the columns {sorted(taken)}")
    path = f"{root}/numbered-{uuid.uuid4().hex}"
    df.select("*", F.spark_partition_id().alias("_part"),
              F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1).alias("_row")).write.parquet(path)
    placed = df.sparkSession.read.parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").count().select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_before") + F.col("_row") + 1).alias(name))


def numbered(df: DataFrame, order: Sequence[Column], root: str, name: str = "position") -> DataFrame:
    """``df`` with the place of each row, from 1, in the order ``order``.

    The rows are dealt out by ranges of the order and sorted within each, then
    numbered as they lie (``in_order``; ranges come from samples, so they must
    not be drawn again). The order should be total: rows that tie in it are
    numbered in any order, and all rows of one tie meet in one partition."""
    return in_order(df.repartitionByRange(*order).sortWithinPartitions(*order), root, name)
