"""Fields of landed pages that the schema does not have, and the landing's check."""

import json

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tunestats import fixtures as fx
from tunestats import schemas
from tunestats.plans import pipeline
from tunestats.sources import field_counts, rest_of_pages


def rest(spark, pages, schema=schemas.PLAYLIST_ITEM_PAGE):
    text = spark.createDataFrame([(p if isinstance(p, str) or p is None else json.dumps(p),) for p in pages], "value string")
    return sorted(tuple(r) for r in rest_of_pages(text, "value", schema).collect())


def test_fields_on_every_level(spark):
    page = {"playlist_id": "p", "total": 3, "items": [
        {"added_at": 5, "is_local": None, "track": {"id": "t", "disc": {"n": 1}, "artists": [{"id": "a", "type": "artist"}, {"id": "b"}]}},
        None, {"track": None, "added_by": "me"}, {"track": {"popularity": "7", "duration_ms": 1.5, "artists": "x"}}, 4]}
    assert rest(spark, [page]) == [
        ("items[]", "type", "BIGINT", "4"), ("items[].added_by", "type", "STRING", '"me"'), ("items[].is_local", "unknown", "VOID", "null"),
        ("items[].track.artists", "type", "STRING", '"x"'), ("items[].track.artists[].type", "unknown", "STRING", '"artist"'),
        ("items[].track.disc", "unknown", "OBJECT<n: BIGINT>", '{"n":1}'), ("items[].track.duration_ms", "type", "DECIMAL(2,1)", "1.5"),
        ("items[].track.popularity", "type", "STRING", '"7"'), ("total", "unknown", "BIGINT", "3")]


def test_pages_without_rest(spark):
    assert rest(spark, [None, "not json", "", {}, {"items": []}, {"items": None, "next": "u"}, {"playlist_id": 7}]) == []
    assert rest(spark, ["[1]", "3"]) == [("", "type", "ARRAY<BIGINT>", "[1]"), ("", "type", "BIGINT", "3")]
    assert rest(spark, []) == []


def test_repeated_pages_count_again_and_no_python_runs(spark):
    text = fx.grown_track_pages(spark, SF_SMALL)
    found = rest_of_pages(text, "value", schemas.TRACK_PAGE, ["kind"])
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    once = {r.path: r.n for r in field_counts(found).collect()}
    twice = {r.path: r.n for r in field_counts(rest_of_pages(text.union(text), "value", schemas.TRACK_PAGE, ["kind"])).collect()}
    assert once and twice == {p: 2 * n for p, n in once.items()}


def test_check_of_a_landing(spark, scratch):
    landing = fx.land(spark, SF_SMALL, f"{scratch}/landing")
    fx.linked_pages(spark, SF_SMALL).where("kind = 'playlists'").select("value").write.mode("append").text(landing["playlists"])
    fx.grown_track_pages(spark, SF_SMALL).where(~F.col("value").contains("explicit") & ~F.col("value").contains("popularity")) \
        .select("value").write.mode("append").text(landing["tracks"])
    pipeline.run_bronze(spark, landing, "tcheck", f"{scratch}/tables")
    told = pipeline.run_check(spark, landing, "tcheck", f"{scratch}/tables")
    chains = {r.status: r.n for r in spark.table("tcheck_bronze.bronze_page_chains").groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert chains["unaddressed"] == 3 and {"complete", "missing", "headless", "cycle"} <= set(chains)
    assert told["broken_chains"] == sum(n for s, n in chains.items() if s != "complete")
    counts = {(r.kind, r.path): r.n for r in spark.table("tcheck_bronze.bronze_rest_counts").collect()}
    assert counts["bronze_playlists", "href"] > 0 and counts["bronze_tracks", "tracks[].album.images"] > 0
    assert sum(counts.values()) == told["bronze_rest_fields"]
    assert told["bronze_track_requests"] > 0 and told["bronze_artist_requests"] > 0
