import random

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tunestats.operators import (
    conform, dedupe, explode_genres, fits_broadcast, left_join_dim, stitch_rows, top1_by_count, top_n,
)
from conftest import rows


def test_conform_casts_reorders_fills_and_drops(spark):
    schema = StructType([StructField("a", StringType()), StructField("b", LongType()), StructField("c", StringType())])
    df = spark.createDataFrame([(1, "x", 9)], "b int, a string, extra int")
    out = conform(df, schema)
    assert out.columns == ["a", "b", "c"]
    assert [f.dataType for f in out.schema.fields] == [StringType(), LongType(), StringType()]
    assert tuple(out.first()) == ("x", 1, None)


def test_dedupe_deterministic_survivor_and_null_key(spark):
    data = [("k1", "b", 2), ("k1", "a", 5), ("k1", None, 7), ("k2", "z", 1), (None, "q", 1), (None, "p", 3)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, s string, v int").repartition(3)
        got = rows(dedupe(df, ["k"]))
        # smallest row by (s, v), NULLs first; the NULL key is one group
        assert got == [(None, "p", 3), ("k1", None, 7), ("k2", "z", 1)]


def test_dedupe_custom_order(spark):
    df = spark.createDataFrame([("k", "b", 1), ("k", "a", 2)], "k string, s string, v int")
    assert rows(dedupe(df, ["k"], order=["v", "s"])) == [("k", "b", 1)]


def test_top_n_and_top1_ties(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",), ("x",), (None,), (None,)], "n string")
    t = top1_by_count(df, "n", "fav").collect()
    assert [(r.fav, r.plays) for r in t] == [("x", 2)]  # tie of 3 groups: smallest name wins, NULL last
    df2 = spark.createDataFrame([(i % 7, i) for i in range(50)], "g int, v int")
    got = [r.v for r in top_n(df2, [F.desc("v")], 3).collect()]
    assert got == [49, 48, 47]


def test_explode_genres_semantics(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None), (4, ["c", None])], "id int, genres array<string>")
    got = rows(explode_genres(df, ["id"]))
    assert got == [(1, "a"), (1, "b"), (4, None), (4, "c")]


def test_left_join_dim_row_preserving_and_right_key(spark):
    fact = spark.createDataFrame([(1, "t1"), (2, "t2"), (3, None), (4, "t1")], "id int, track_id string")
    dim = spark.createDataFrame([("t1", "one"), ("t9", "nine")], "track_id string, name string")
    for limit in (10, 0, None):  # broadcast, shuffle join, optimizer's choice
        got = rows(left_join_dim(fact, dim, "track_id", broadcast_max_bytes=limit), "id", "track_id", "name")
        assert sorted(got) == [(1, "t1", "one"), (2, None, None), (3, None, None), (4, "t1", "one")]


def test_fits_broadcast_compares_bytes(spark, scratch):
    """Few but very wide rows exceed the bound that many narrow ones keep."""
    long = F.concat(*[F.sha2(F.concat("id", F.lit(str(i))).cast("string"), 256) for i in range(200)])
    spark.range(300).select("id", F.array(long).alias("genres")).write.parquet(f"{scratch}/wide")
    spark.range(3000).write.parquet(f"{scratch}/narrow")
    wide, narrow = spark.read.parquet(f"{scratch}/wide"), spark.read.parquet(f"{scratch}/narrow")
    assert fits_broadcast(narrow, 1 << 20) and not fits_broadcast(wide, 1 << 20) and fits_broadcast(wide)
    plan = left_join_dim(spark.range(10), wide, "id", 1 << 20)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower()
    plan = left_join_dim(spark.range(10), narrow, "id", 1 << 20)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan.lower()



def test_stitch_rows_cross_product_semantics(spark):
    schema = StructType([StructField("a", LongType()), StructField("b", StringType()), StructField("c", StringType())])
    one = spark.createDataFrame([(7,)], "a bigint")
    fav = spark.createDataFrame([(None,)], "b string")
    top = spark.createDataFrame([("t",)], "c string")
    assert [tuple(r) for r in stitch_rows([one, fav, top], schema).collect()] == [(7, None, "t")]
    empty = spark.createDataFrame([], "c string")
    assert stitch_rows([one, fav, empty], schema).count() == 0
