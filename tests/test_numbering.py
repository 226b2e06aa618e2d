"""Numbering of whole tables by partition counts and prefix sums."""

import pytest
from pyspark.sql import functions as F

from tunestats.operators import numbered


def test_places_are_those_of_a_sort(spark, scratch):
    df = spark.range(0, 5000, numPartitions=7).select(F.xxhash64("id").alias("h"), (F.col("id") % 13).cast("string").alias("s"))
    got = numbered(df.withColumn("s", F.when(F.col("s") != "3", F.col("s"))), [F.asc_nulls_last("s"), F.asc("h")], scratch)
    rows = sorted(got.collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(1, 5001))
    want = sorted(((r.s, r.h) for r in rows), key=lambda t: (t[0] is None, t[0] or "", t[1]))
    assert [(r.s, r.h) for r in rows] == want


def test_no_window_over_the_rows(spark, scratch):
    got = numbered(spark.range(100), [F.asc("id")], scratch)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "Aggregate" in window            # the only window reads the counts of partitions


def test_empty_table_and_clashing_names(spark, scratch):
    assert numbered(spark.range(0), [F.asc("id")], scratch).count() == 0
    with pytest.raises(ValueError):
        numbered(spark.range(1).withColumn("Position", F.lit(1)), [F.asc("id")], scratch)
