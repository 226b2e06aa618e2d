"""Hot keys: one track and the NULL key each hold a third of the plays."""

import contextlib
import io

from pyspark.sql import functions as F

from tunestats.operators import dedupe, left_join_dim
from tunestats.plans import marts, model


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _fct(spark, n=30000):
    ids = F.col("id")
    track = (F.when(ids % 3 == 0, F.lit("hot"))
             .when(ids % 3 == 1, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("t"), (ids % 500).cast("string"))))
    return spark.range(n).select(
        F.sha2(ids.cast("string"), 256).alias("play_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + ids * 60).alias("play_timestamp"),
        track.alias("track_id"),
        (ids % 40).cast("string").alias("artist_id"),
        F.lit(None).cast("string").alias("album_id"),
        (ids * 37 % 300000).alias("duration_ms"),
        F.lit("x").alias("context_type"),
    ).repartition(16)


def test_hot_key_shuffle_join_is_split_and_correct(spark):
    fct = _fct(spark)
    # dims as stored tables give them (unique on the key, no inline de-dup)
    tracks = spark.range(500).select(
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("track_id"),
        F.lit("n").alias("track_name"), F.col("id").alias("popularity")).union(
        spark.createDataFrame([("hot", "Hot", 99)], "track_id string, track_name string, popularity bigint"))
    artists = spark.range(40).select(F.col("id").cast("string").alias("artist_id"), F.lit("a").alias("artist_name"),
                                     F.array(F.lit("g")).alias("genres"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        shuffled = marts.base_analytics(fct, tracks, artists, broadcast_max_bytes=None).select(
            "play_id", "track_id", "popularity")
        got = shuffled.collect()
        assert "skew=true" in _plan(shuffled)  # the hot and the NULL partitions were split
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    broadcast = marts.base_analytics(fct, tracks, artists)
    want = broadcast.select("play_id", "track_id", "popularity").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert len(got) == fct.count()
    assert sum(1 for r in got if r.track_id == "hot") == 10000


def test_hot_key_dedupe_and_aggregates_combine_map_side(spark):
    fct = _fct(spark).withColumn("play_id", F.when(F.col("track_id") == "hot", F.lit("same")).otherwise(F.col("play_id")))
    d = dedupe(fct, ["play_id"])
    assert "partial_min" in _plan(d)
    assert d.where("play_id = 'same'").count() == 1
    base = marts.base_analytics(model.fct_plays(spark.createDataFrame([], "played_at string, track_id string, "
                                                                       "artist_id string, album_id string, "
                                                                       "duration_ms bigint, context_type string"))
                                .unionByName(fct), spark.createDataFrame([], "track_id string, track_name string, "
                                                                         "popularity bigint"),
                                spark.createDataFrame([], "artist_id string, artist_name string, "
                                                      "genres array<string>"))
    plan = _plan(marts.listening_patterns(base))
    assert "partial_sum" in plan
