"""Landed stand-in pages: same plays, packed without a shuffle, compressed."""

from __future__ import annotations

import glob

import pyarrow as pa
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tunestats import fixtures as fx
from tunestats import schemas
from tunestats.plans import marts, model, pipeline, refresh
from tunestats.session import SCALE_CONF
from tunestats.sinks import load_all, stored
from tunestats.sources import flatten_play_history, flatten_playlist_tracks, flatten_playlists, parse_pages


def same(a, b):
    assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_pages_are_packed_without_a_wide_shuffle(spark):
    plays, items = fx.play_pages_li(spark, SF_SMALL), fx.playlist_item_pages(spark, SF_SMALL)
    assert "Exchange" not in plays._jdf.queryExecution().executedPlan().toString()
    # items of one playlist lie apart: one shuffle, of the columns read, before anything is made of them
    dealt = items._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert len(dealt) == 2 and "Track" in dealt[0] and "Track" not in dealt[1]
    same(flatten_play_history(parse_pages(plays, "value", schemas.PLAY_PAGE)), fx.plays_li(spark, SF_SMALL))
    same(flatten_playlist_tracks(parse_pages(items, "value", schemas.PLAYLIST_ITEM_PAGE)), fx.playlist_tracks_raw(spark, SF_SMALL))
    assert items.count() == fx.table(spark, SF_SMALL, "lineitem").select("l_orderkey").distinct().count()


def test_packer_keeps_runs_over_batches_nulls_and_scattered_pages():
    def batch(*pages):
        return pa.record_batch({"_page": pa.array(pages, pa.int64()), "w": pa.array([{"v": p} for p in pages], pa.struct([("v", pa.int64())]))})

    batches = [batch(1, 1, 2), batch(2, 2), batch(), batch(2), batch(None, None), batch(None, 1), batch(3)]
    out = [(p, [w["v"] for w in ws]) for b in fx._packer()(iter(batches)) for p, ws in zip(*(b.column(i).to_pylist() for i in (0, 1)))]
    assert out == [(1, [1, 1]), (2, [2] * 4), (None, [None] * 3), (1, [1]), (3, [3])]


def test_landing_is_compressed_in_several_files(spark, scratch, monkeypatch):
    monkeypatch.setattr(fx, "FILE_PAGES", 20)
    pages = fx.play_pages_li(spark, SF_SMALL)
    fx.land_pages(pages, f"{scratch}/plays")
    files = glob.glob(f"{scratch}/plays/part-*")
    assert len(files) > 3 and all(f.endswith(".gz") for f in files)
    same(spark.read.text(f"{scratch}/plays"), pages.select("value"))


def test_buckets_grow_with_the_plays():
    assert entry._time_buckets(0) == entry._time_buckets(600_000) == 8 and entry._time_buckets(216_000_000) == 108


def test_plays_are_hashed_after_they_are_dealt_out(spark, scratch):
    raw = fx.plays_li(spark, SF_SMALL)
    rows = model.unkeyed_plays(raw, scratch)
    assert "play_id" not in rows.columns
    same(model.keyed_plays(rows), model.fct_plays(raw))


def test_track_ranking_with_names_joined_last(spark):
    base = marts.base_analytics(model.fct_plays(fx.plays_li(spark, SF_SMALL)), tracks := model.dim_tracks(fx.tracks_raw(spark, SF_SMALL)),
                                model.dim_artists(fx.artists_raw(spark, SF_SMALL)))
    same(marts.top_tracks(base, tracks=tracks), marts.top_tracks(base))
    plan = marts.top_tracks(base.select(*base.columns), tracks=tracks)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Aggregate [" in line and "track_name" in line.split("]")[0] and "artist_name" in line.split("]")[0] for line in plan.split("\n"))


def test_refresh_shuffles_the_keys_bytes(spark, scratch):
    spark.sql("CREATE SCHEMA IF NOT EXISTS tb_bytes")
    rows, months = refresh.merged_plays(refresh.open_layer(spark, "tb_bytes", scratch), raw := fx.plays_li(spark, SF_SMALL))
    same(rows.drop(refresh.MONTH), model.fct_plays(raw))
    assert set(months) == {r[0] for r in rows.select(refresh.MONTH).distinct().collect()}
    assert rows.select("play_id").where(F.col("play_id").isNotNull() & ~F.col("play_id").rlike("^[0-9a-f]{64}$")).isEmpty()


def test_linked_pages_sort_only_what_is_read(spark):
    plan = fx.linked_pages(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    dealt = plan.index("RepartitionByExpression")
    assert plan.index("collect_list") < dealt


def test_every_kind_of_page_lands(spark, scratch):
    landed = fx.land(spark, SF_SMALL, scratch)
    assert landed.keys() == {"plays", "playlists", "playlist_tracks", "tracks", "artists"}
    same(flatten_playlists(parse_pages(spark.read.text(landed["playlists"]), "value", schemas.PLAYLIST_PAGE)),
         fx.playlists_raw(spark, SF_SMALL))


def _run(spark, scratch, db):
    landing = fx.land(spark, SF_SMALL, f"{scratch}/landing")
    pipeline.run(spark, landing, db, f"{scratch}/tables", time_buckets=4, ordered=True)
    return model.fct_plays(fx.plays_li(spark, SF_SMALL))


def test_stored_plays_hold_the_keys_text_and_names_its_hash(spark, scratch):
    fct = _run(spark, scratch, "tb_text")
    for name in ("tb_text_silver.fct_plays", "tb_text_gold.base_analytics"):
        files = stored(spark, name)
        assert "play_id" not in files.columns and "play_id" in spark.table(name).columns
        texts = files.select(F.sha2("play_key", 256))
        assert not spark.table(name).select("play_id").exceptAll(texts).count() and files.count() == fct.count()
    same(spark.table("tb_text_silver.fct_plays"), fct)
    assert spark.table("tb_text_silver.fct_plays").schema.simpleString() == schemas.FCT_PLAYS.simpleString()
    assert spark.table("tb_text_gold.base_analytics").schema.simpleString() == schemas.BASE_ANALYTICS.simpleString()
    same(spark.table("tb_text_gold.base_analytics"), marts.base_analytics(fct, spark.table("tb_text_silver.dim_tracks"),
                                                                          spark.table("tb_text_silver.dim_artists")))


def test_wide_table_of_plays_that_hold_hashes(spark, scratch):
    fct = _run(spark, scratch, "tb_hashed")
    load_all({"fct_plays": fct}, "tb_hashed_silver", root=f"{scratch}/tables/silver")        # as another writer stores them
    pipeline.run_gold(spark, "tb_hashed", f"{scratch}/tables")
    assert "play_id" in stored(spark, "tb_hashed_gold.base_analytics").columns
    same(spark.table("tb_hashed_gold.base_analytics"), marts.base_analytics(fct, spark.table("tb_hashed_silver.dim_tracks"),
                                                                            spark.table("tb_hashed_silver.dim_artists")))


def test_keys_of_one_text_are_one_play_whatever_their_parts(spark, scratch):
    raw = spark.createDataFrame([
        ("2024-01-01T00:00:00", "Zx", "a", 5), ("2024-01-01T00:00:00Z", "x", "b", 4), ("2024-01-01T00:00:01Z", "y", "a", 3),
        ("2024-01-01T00:00:01Z", "y", "a", 2), (None, "t", "a", 1), ("2024-01-02T00:00:00Z", None, "b", 1), ("bad", "t", "a", 9),
        (None, None, None, None)], "played_at string, track_id string, artist_id string, duration_ms bigint").selectExpr(
        "*", "'n' AS track_name", "'n' AS artist_name", "'c' AS context_type", "'d' AS album_id", "'n' AS album_name")
    want = raw.selectExpr("played_at || track_id AS k", "try_to_timestamp(played_at) AS t", "track_id", "artist_id", "duration_ms").groupBy("k").agg(
        F.min(F.struct("t", "track_id", "artist_id", "duration_ms")).alias("s")).select(F.sha2("k", 256), "s.*")
    for root in (None, scratch):
        got = model.keyed_plays(model.unkeyed_plays(raw, root)).select("play_id", "play_timestamp", "track_id", "artist_id", "duration_ms")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() == 4
        rows = model.text_keyed_plays(model.unkeyed_plays(raw, root))
        same(rows.selectExpr(*model.hashed_view(schemas.FCT_PLAYS)), model.fct_plays(raw, root))


def test_plays_are_dealt_to_buckets_by_what_they_landed_with(spark, scratch):
    rows = model.unkeyed_plays(fx.plays_li(spark, SF_SMALL), scratch)
    assert set(rows.columns) == {"played_at", "track_id", "artist_id", "album_id", "duration_ms", "context_type"}


def test_ordered_track_ranking_is_dealt_out_before_names_are_joined(spark, scratch):
    fct = model.fct_plays(fx.plays_li(spark, SF_SMALL))
    tracks, artists = model.dim_tracks(fx.tracks_raw(spark, SF_SMALL)), model.dim_artists(fx.artists_raw(spark, SF_SMALL))
    spark.sql("CREATE SCHEMA IF NOT EXISTS tb_rank")
    load_all({"tracks": tracks, "base": marts.base_analytics(fct, tracks, artists)}, "tb_rank", root=scratch)
    base, dim = spark.table("tb_rank.base"), spark.table("tb_rank.tracks")
    plan = marts.top_tracks(base, True, dim)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("RepartitionByExpression")
    want = [tuple(r) for r in marts.top_tracks(base, True).collect()]
    assert want and [tuple(r) for r in marts.top_tracks(base, True, dim).collect()] == want
    spark.conf.set("tunestats.broadcast.maxBytes", "-1")
    try:
        assert [tuple(r) for r in marts.top_tracks(base, True, dim).collect()] == want
    finally:
        spark.conf.unset("tunestats.broadcast.maxBytes")


def test_pages_are_dealt_without_a_column_for_the_page(spark):
    items = fx.playlist_item_pages(spark, SF_SMALL)
    dealt = items._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    assert "_page" not in dealt and items._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_catalogue_rows_that_occur_once_are_not_shuffled(spark, scratch):
    raw = fx.playlists_raw(spark, SF_SMALL)
    again = raw.unionByName(raw.where("playlist_id LIKE '%7'").withColumn("playlist_name", F.lit("!")))
    same(model.dim_playlists(again, scratch), model.dim_playlists(again))
    once = raw.where("playlist_id NOT LIKE '%7'").dropDuplicates(["playlist_id"])
    load_all({"once": once}, "default", root=scratch)
    assert "Exchange" not in model.dim_playlists(spark.table("default.once"), scratch)._jdf.queryExecution().executedPlan().toString()


def test_artist_ranking_counts_tracks_without_carrying_sums(spark, scratch):
    tracks, artists = model.dim_tracks(fx.tracks_raw(spark, SF_SMALL)), model.dim_artists(fx.artists_raw(spark, SF_SMALL))
    base = marts.base_analytics(model.fct_plays(fx.plays_li(spark, SF_SMALL)), tracks, artists)
    # an artist none of whose plays has a track
    only = base.select("artist_id").where("artist_id IS NOT NULL").first()[0]
    base = base.withColumn("track_id", F.when(F.col("artist_id") != only, F.col("track_id")))
    got = marts.top_artists(base, artists=artists)
    same(got, marts.top_artists(base))
    assert got.schema.simpleString() == schemas.GOLD_TOP_ARTISTS.simpleString() and got.where(F.col("artist_id") == only).first()["unique_tracks"] == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not any("sum(" in line and "track_id" in line.split("]")[0] for line in plan.split("\n") if "Aggregate [" in line)


def test_a_task_reads_a_bounded_share_of_the_stored_plays():
    assert SCALE_CONF["spark.sql.files.maxPartitionBytes"] == "32m"
