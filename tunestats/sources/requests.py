"""What is still to be asked for: harvested ids without a catalogue row.

The catalogue answers lists of at most 50 ids. ``missing_requests`` compares the
harvested ids with the rows that have landed and cuts the rest into such
lists. The ids are numbered over the whole table by partition counts and
prefix sums (``operators.numbered``), so no task sees them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunestats.operators import numbered

REQUEST_IDS = 50      # fixed value: ids that one catalogue request may name


def missing_keys(keys: DataFrame, catalogue: DataFrame, key: str) -> DataFrame:
    """The ids of ``keys`` without a row in ``catalogue``: each once, no nulls
    and no empty ids."""
    wanted = keys.select(key).where(F.length(key) > 0).distinct()
    return wanted.join(catalogue.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def missing_requests(keys: DataFrame, catalogue: DataFrame, key: str, root: str, size: int = REQUEST_IDS) -> DataFrame:
    """(request, n_ids, ids): numbered requests, in order of the ids, each with
    the next ``size`` of them joined by commas; the last may be shorter. With
    nothing missing there are no rows."""
    placed = numbered(missing_keys(keys, catalogue, key), [F.asc(key)], root)
    lists = placed.groupBy(F.floor((F.col("position") - 1) / size).alias("request")).agg(F.sort_array(F.collect_list(key)).alias("ids"))
    return lists.select(F.col("request").cast("long"), F.size("ids").cast("long").alias("n_ids"), F.array_join("ids", ",").alias("ids"))
