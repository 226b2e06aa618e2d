"""Orders as a property of frames and of files: the place is read, not made."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tunestats import fixtures as fx
from tunestats.operators import in_order
from tunestats.plans import marts, model
from tunestats.sinks import ensure_schema, in_file_order, load_all


@pytest.fixture(scope="module")
def base(spark):
    return marts.base_analytics(model.fct_plays(fx.plays_li(spark, SF_SMALL)), model.dim_tracks(fx.tracks_raw(spark, SF_SMALL)),
                              model.dim_artists(fx.artists_raw(spark, SF_SMALL)))


ORDERS = {
    "top_tracks": lambda r: (-r.play_count, r.track_id, r.track_name or "", r.artist_name or ""),
    "top_artists": lambda r: (-r.total_plays, r.artist_id),
    "genre_trends": lambda r: (r.month or "", -r.total_plays, r.genre),
    "listening_patterns": lambda r: (-1 if r.hour_of_day is None else r.hour_of_day, r.weekday_name or ""),
}


def follows(placed, key):
    rows = sorted(placed.collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(1, len(rows) + 1))
    return [key(r) for r in rows] == sorted(key(r) for r in rows)


@pytest.mark.parametrize("name", ORDERS)
def test_place_follows_the_sort_and_is_lost_without_it(spark, base, scratch, name):
    mart = getattr(marts, name)
    assert follows(in_order(mart(base, ordered=True), scratch), ORDERS[name])
    assert not follows(in_order(mart(base).repartition(5), scratch), ORDERS[name])


@pytest.mark.parametrize("name", ["top_tracks", "genre_trends"])
def test_files_keep_the_order(spark, base, scratch, name):
    ensure_schema(spark, "tor", location=f"{scratch}/db")
    mart = getattr(marts, name)
    load_all({"sorted": mart(base, ordered=True), "unsorted": mart(base).repartition(5)}, "tor", root=scratch)
    assert follows(in_file_order(spark, "tor.sorted"), ORDERS[name])
    assert not follows(in_file_order(spark, "tor.unsorted"), ORDERS[name])


def test_many_files_and_empty_parts(spark, scratch):
    ensure_schema(spark, "tor2", location=f"{scratch}/db")
    df = spark.range(0, 1200, numPartitions=13).withColumn("h", F.xxhash64("id")).where("id % 7 < 3").orderBy("h")
    load_all({"t": df}, "tor2", root=scratch)
    assert follows(in_file_order(spark, "tor2.t"), lambda r: r.h)
    load_all({"t": df.limit(0)}, "tor2", root=scratch)
    assert in_file_order(spark, "tor2.t").count() == 0
