"""Dimensions whose files are small and which are large in memory: what the driver
would have to hold is measured, and beyond the bound it is held part by part or not at all."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tunestats import schemas
from tunestats.operators import (
    BROADCAST_CONF,
    broadcast_parts,
    conform,
    estimated_bytes,
    fits_broadcast,
    in_part,
    left_join_dim,
    measured_bytes,
    unless_large,
)
from tunestats.plans import marts, model, pipeline, refresh
from tunestats.sinks import Layer, ensure_schema, in_file_order, load_all, write_parts

BOUND = 150_000


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def plays(spark, n=6000):
    k = F.col("id")
    at = F.concat(F.lit("2024-0"), (k % 3 + 1).cast("string"), F.lit("-1"), (k % 10).cast("string"), F.lit("T0"), (k % 7).cast("string"), F.lit(":15:00.000Z"))
    return spark.range(n).select(
        F.when(k % 50 != 0, at).alias("played_at"),
        F.when(k % 3 == 0, F.lit("7")).when(k % 11 != 0, (k % 4500).cast("string")).alias("track_id"),       # a hot one, none, some beyond the catalogue
        (k % 60).cast("string").alias("artist_id"), F.lit("1").alias("album_id"), (k * 37 % 9000).alias("duration_ms"), F.lit("x").alias("context_type"))


def catalogue(spark):
    k = F.col("id")
    tracks = spark.range(4000).select(k.cast("string").alias("track_id"), F.concat(F.lit("n"), (k % 5).cast("string")).alias("track_name"), (k % 90).alias("popularity"))
    artists = spark.range(50).select(k.cast("string").alias("artist_id"), F.lit("a").alias("artist_name"),
                                     F.when(k % 5 != 1, F.array(F.lit("g"), (k % 4).cast("string"))).alias("genres"))
    return conform(tracks, schemas.DIM_TRACKS), conform(artists, schemas.DIM_ARTISTS)


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("broadcast"))
    tracks, artists = catalogue(spark)
    pipeline._prepare(spark, "tbc", root)
    load_all({"dim_tracks": tracks.coalesce(1), "dim_artists": artists.coalesce(1), "dim_time": model.dim_time(plays(spark)),
              "dim_playlists": spark.createDataFrame([], schemas.DIM_PLAYLISTS), "fct_plays": model.text_keyed_plays(model.unkeyed_plays(plays(spark)))},
             "tbc_silver", root=f"{root}/silver", views={"fct_plays": model.hashed_view(schemas.FCT_PLAYS)})
    return root


@pytest.fixture
def bound(spark):
    spark.conf.set(BROADCAST_CONF, str(BOUND))
    yield BOUND
    spark.conf.unset(BROADCAST_CONF)


def star(spark):
    return [spark.table(f"tbc_silver.{t}") for t in ("fct_plays", "dim_tracks", "dim_artists")]


def test_the_size_is_that_in_memory(spark, silver):
    dim = spark.table("tbc_silver.dim_tracks").select("track_id", "track_name", "popularity")
    assert estimated_bytes(dim) <= BOUND < measured_bytes(dim) and not fits_broadcast(dim, BOUND) and fits_broadcast(dim)
    joined = left_join_dim(spark.range(9).select(F.col("id").cast("string").alias("track_id")), dim, "track_id", BOUND)
    assert "strategy=broadcast" not in plan(joined) and "strategy=merge" in plan(joined)
    assert "merge" in plan(unless_large(dim, BOUND)) + plan(dim.join(unless_large(dim, BOUND), "track_id"))
    assert unless_large(dim, 1 << 28) is dim and unless_large(dim, None) is dim and unless_large(dim, -1) is dim
    nested = spark.range(100).select("id", F.array(F.lit("x" * 1000)).alias("g"), F.struct(F.lit("y" * 1000).alias("v")).alias("s"))
    assert measured_bytes(nested) >= 200_000 and measured_bytes(nested.limit(0)) == 0


def test_measured_as_spark_builds_it(spark, silver):
    dim = spark.table("tbc_silver.dim_tracks").select("track_id", "track_name", "popularity")
    many = spark.range(100_000).select(F.col("id").cast("string").alias("track_id"), F.lit("a name").alias("track_name"), F.col("id").alias("popularity"))
    joined = spark.range(9).select(F.col("id").cast("string").alias("track_id")).join(
        F.broadcast(many.select(F.col("track_id").alias("_dim_key"), "*")), "track_id")
    joined.collect()

    def exchanges(node):
        name = node.getClass().getSimpleName()
        if name == "BroadcastExchangeExec":
            yield node.metrics().apply("dataSize").value()
        below = [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else [node.plan()] if name.endswith("QueryStageExec") else []
        for child in [*below, *(node.children().apply(i) for i in range(node.children().size()))]:
            yield from exchanges(child)

    real = max(exchanges(joined._jdf.queryExecution().executedPlan()))
    assert 0.5 * real <= measured_bytes(many) <= 2 * real
    assert 100 * 4000 <= measured_bytes(dim) <= 200 * 4000


def test_parts_bound_the_broadcast_and_make_up_the_table(spark, silver, bound):
    fct, tracks, artists = star(spark)
    parts = marts.base_parts(fct, tracks, artists)
    assert len(parts) == broadcast_parts(tracks.select("track_id", "track_name", "popularity"), BOUND) > 2
    assert all("strategy=broadcast" in plan(p) for p in parts)
    for i in range(len(parts)):
        assert measured_bytes(tracks.select("track_id", "track_name", "popularity").where(in_part("track_id", i, len(parts)))) <= BOUND
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    want = rows(marts.base_analytics(fct, tracks, artists, broadcast_max_bytes=None))
    assert rows(union) == want and len(want) == fct.count() and any(r[5] is None for r in want)
    timed = marts.base_parts(fct, tracks, artists, spark.table("tbc_silver.dim_time"))
    assert sorted(sum((rows(p) for p in timed), []), key=str) == sorted(want, key=str)


def test_too_many_parts_are_one_by_a_shuffle(spark, silver):
    fct, tracks, artists = star(spark)
    dim = tracks.select("track_id", "track_name", "popularity")
    assert broadcast_parts(dim, 1 << 28) == 1 and broadcast_parts(dim, -1) == 1 and broadcast_parts(dim, None) == 1
    few = dim.where("track_id < '2'")
    assert broadcast_parts(dim, measured_bytes(dim) - 1) == 3
    assert few.count() and broadcast_parts(dim, max(estimated_bytes(dim), measured_bytes(dim) // 40)) in (1, *range(3, 17))


def test_write_parts_one_after_the_other(spark, scratch):
    df = spark.range(100)
    assert write_parts([df.where("id < 30"), df.limit(0), df.where("id >= 30")], f"{scratch}/parts") == 100
    assert rows(spark.read.parquet(f"{scratch}/parts")) == [(i,) for i in sorted(range(100), key=str)]
    ensure_schema(spark, "tbc_parts", location=f"{scratch}/db")
    assert load_all({"t": [df.limit(0), df]}, "tbc_parts", root=scratch) == {"t": 100} and spark.table("tbc_parts.t").count() == 100


def test_gold_layer_is_the_same_with_parts(spark, silver):
    def gold(database_root):
        written = pipeline.run_gold(spark, "tbc", database_root, ordered=True)
        return written, {t: rows(spark.table(f"tbc_gold.{t}")) for t in ("base_analytics", *pipeline.GOLD)}, [
            tuple(r)[:-1] for r in in_file_order(spark, "tbc_gold.gold_top_tracks").orderBy("position").collect()]

    want = gold(silver)
    spark.conf.set(BROADCAST_CONF, str(BOUND))
    try:
        _, tracks, _ = star(spark)
        assert "Join" not in plan(marts.top_tracks(spark.table("tbc_gold.base_analytics"), tracks=tracks))     # names of the wide table
        got = gold(silver)
    finally:
        spark.conf.unset(BROADCAST_CONF)
    assert got == want and want[0]["base_analytics"] == len(want[1]["base_analytics"]) > 0


def test_kept_up_sums_do_not_broadcast_a_large_catalogue(spark, silver, scratch, bound):
    _, tracks, artists = star(spark)
    refresh.refresh(spark, plays(spark), tracks, artists, "tbc_live", f"{scratch}/live")
    layer = refresh.open_layer(spark, "tbc_live", f"{scratch}/live")
    assert isinstance(layer, Layer)
    made = refresh._sums(tracks, artists)
    facts = {refresh.FACT: layer.table(refresh.FACT)}
    assert "strategy=merge" in plan(made[refresh.GENRES](facts)) and "Join" not in plan(made[refresh.PATTERNS](facts))
    base = marts.base_analytics(refresh.fct_plays(layer), tracks, artists, broadcast_max_bytes=None)
    assert rows(refresh.genre_trends(layer)) == rows(marts.genre_trends(base))
    assert rows(refresh.listening_patterns(layer)) == rows(marts.listening_patterns(base))
