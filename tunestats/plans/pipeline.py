"""The three layers, end to end.

``run`` reads landed pages, writes the raw play, playlist and playlist
item tables, restricts the landed catalogue pages to the ids harvested from
those stored tables and writes them, builds the star schema
from the written raw tables, the wide play table from the written star
schema, and the aggregates from the written wide table. Each layer reads
only stored tables of the layer before it, so every layer is a durable
restart point (lineage is cut at each write; a lost executor costs at most
the tasks of the current layer) and each layer can run as its own job.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunestats import schemas
from tunestats.functions import DEFAULT_USER, parse_ts
from tunestats.plans import marts, model
from tunestats.session import apply_scale_conf, shared_dir
from tunestats.sinks import ensure_schema, load_all, stored
from tunestats.sources import (
    corrupt_pages,
    enrich,
    field_counts,
    harvest_keys,
    missing_requests,
    page_chains,
    read_links,
    read_raw,
    read_rest,
    recent,
    window_start,
)

RAW = ("bronze_play_history", "bronze_playlists", "bronze_playlist_tracks", "bronze_tracks", "bronze_artists")
SILVER = ("dim_time", "dim_tracks", "dim_artists", "dim_playlists", "fct_plays")
GOLD = ("gold_user_listening_summary", "gold_top_tracks", "gold_top_artists", "gold_genre_trends",
        "gold_listening_patterns")

RAW_SCHEMAS = {
    "bronze_play_history": schemas.BRONZE_PLAY_HISTORY, "bronze_playlists": schemas.BRONZE_PLAYLISTS,
    "bronze_playlist_tracks": schemas.BRONZE_PLAYLIST_TRACKS, "bronze_tracks": schemas.BRONZE_TRACKS,
    "bronze_artists": schemas.BRONZE_ARTISTS,
}

# Landing folders by kind of page.
LANDING_KEYS = {
    "plays": "bronze_play_history",
    "playlists": "bronze_playlists",
    "playlist_tracks": "bronze_playlist_tracks",
    "tracks": "bronze_tracks",
    "artists": "bronze_artists",
}


ACTIVITY = ("bronze_play_history", "bronze_playlists", "bronze_playlist_tracks")
CATALOGUE = ("bronze_tracks", "bronze_artists")


def bronze_activity(spark: SparkSession, landing: Mapping[str, str | list[str]],
                    run_ts: str | datetime | None = None, window_hours: int = 24,
                    mode: str = "FAILFAST", multi_line: bool = False) -> dict[str, DataFrame]:
    """Raw plays, playlists and playlist items from landed pages (``landing``
    maps ``plays``, ``playlists``, ``playlist_tracks`` to paths). With
    ``run_ts`` only plays after ``run_ts - window_hours`` are kept; of a plays
    folder landed by day (``land_date=...``) earlier days are then not read,
    as a play lands on its own day or later."""
    since = None if run_ts is None else F.to_date(window_start(run_ts, window_hours))
    raw = {LANDING_KEYS[k]: read_raw(spark, LANDING_KEYS[k], landing[k], mode, multi_line, since if k == "plays" else None)
           for k in ("plays", "playlists", "playlist_tracks")}
    if run_ts is not None:
        raw["bronze_play_history"] = recent(raw["bronze_play_history"], run_ts, window_hours)
    return raw


def bronze_catalogue(spark: SparkSession, landing: Mapping[str, str | list[str]], plays: DataFrame,
                     playlist_tracks: DataFrame, mode: str = "FAILFAST", multi_line: bool = False) -> dict[str, DataFrame]:
    """Raw track and artist catalogue rows from landed pages, restricted to
    the ids harvested from ``plays`` and ``playlist_tracks`` (pass the
    stored raw tables: the harvest then reads two columns of each)."""
    track_keys, artist_keys = harvest_keys(plays, playlist_tracks)
    return {
        "bronze_tracks": enrich(read_raw(spark, "bronze_tracks", landing["tracks"], mode, multi_line), track_keys, "track_id"),
        "bronze_artists": enrich(read_raw(spark, "bronze_artists", landing["artists"], mode, multi_line), artist_keys,
                                 "artist_id"),
    }


def bronze_tables(spark: SparkSession, landing: Mapping[str, str | list[str]],
                  run_ts: str | datetime | None = None, window_hours: int = 24,
                  mode: str = "FAILFAST", multi_line: bool = False) -> dict[str, DataFrame]:
    """All five raw tables as DataFrames (nothing stored in between)."""
    act = bronze_activity(spark, landing, run_ts, window_hours, mode, multi_line)
    cat = bronze_catalogue(spark, landing, act["bronze_play_history"], act["bronze_playlist_tracks"], mode, multi_line)
    return {k: {**act, **cat}[k] for k in RAW}


def bronze_corrupt(spark: SparkSession, landing: Mapping[str, str | list[str]], run_ts: str | datetime | None = None,
                   window_hours: int = 24, multi_line: bool = False) -> DataFrame:
    """(kind, page, empty): the landed pages that a permissive run passes over
    (see ``sources.corrupt_pages``)."""
    since = None if run_ts is None else F.to_date(window_start(run_ts, window_hours))
    parts = [corrupt_pages(spark, LANDING_KEYS[k], path, multi_line, since if k == "plays" else None)
             for k, path in landing.items()]
    return reduce(DataFrame.unionByName, parts)


def silver_tables(raw: Mapping[str, DataFrame], root: str | None = None, unkeyed: bool = False) -> dict[str, DataFrame]:
    """Star schema from the raw tables (``root``: see ``model.fct_plays``);
    ``unkeyed``: the plays as yet without their keys (``model.unkeyed_plays``)."""
    return {
        "dim_time": model.dim_time(raw["bronze_play_history"]),
        "dim_tracks": model.dim_tracks(raw["bronze_tracks"], root),
        "dim_artists": model.dim_artists(raw["bronze_artists"]),
        "dim_playlists": model.dim_playlists(raw["bronze_playlists"], root),
        "fct_plays": (model.unkeyed_plays if unkeyed else model.fct_plays)(raw["bronze_play_history"], root),
    }


def gold_tables(base: DataFrame, user_id: str = DEFAULT_USER, artists: DataFrame | None = None,
                ordered: bool = False, tracks: DataFrame | None = None) -> dict[str, DataFrame]:
    """Aggregate tables from the wide play table (and ``dim_artists`` and
    ``dim_tracks``, see ``marts.top_artists``, ``marts.top_tracks``); ``ordered``: in the reference's row order."""
    return {
        "gold_user_listening_summary": marts.user_summary(base, user_id),
        "gold_top_tracks": marts.top_tracks(base, ordered, tracks),
        "gold_top_artists": marts.top_artists(base, ordered, artists),
        "gold_genre_trends": marts.genre_trends(base, user_id, ordered),
        "gold_listening_patterns": marts.listening_patterns(base, user_id, ordered),
    }


def empty_raw(spark: SparkSession, name: str) -> DataFrame:
    """A raw table without rows."""
    return spark.createDataFrame([], RAW_SCHEMAS[name])


def _read(spark: SparkSession, database: str, names) -> dict[str, DataFrame]:
    return {n: spark.table(f"{database}.{n}") for n in names}


def _databases(database: str) -> dict[str, str]:
    return {layer: f"{database}_{layer}" for layer in ("bronze", "silver", "gold")}


def _prepare(spark: SparkSession, database: str, root: str | None) -> dict[str, str]:
    apply_scale_conf(spark)
    dbs = _databases(database)
    for layer, db in dbs.items():
        ensure_schema(spark, db, location=f"{root}/{layer}/_db" if root else None)
    return dbs


def _loc(root: str | None, layer: str) -> str | None:
    return f"{root}/{layer}" if root else None


def run_bronze(spark: SparkSession, landing: Mapping[str, str | list[str]], database: str = "tunestats",
               root: str | None = None, run_ts: str | datetime | None = None, window_hours: int = 24,
               fmt: str = "parquet", mode: str = "FAILFAST", multi_line: bool = False) -> dict[str, int | None]:
    """Layer 1: landed pages → the five raw tables. A raw table for which
    nothing has landed keeps its contents (``None``). ``mode`` and
    ``multi_line`` are those of the page reader; a ``PERMISSIVE`` run also
    stores the text of broken pages as ``bronze_corrupt_pages`` and tells
    their number."""
    dbs = _prepare(spark, database, root)
    written = load_all(bronze_activity(spark, landing, run_ts, window_hours, mode, multi_line), dbs["bronze"], fmt,
                       _loc(root, "bronze"), skip_empty=True)
    for name in ACTIVITY:                                   # nothing landed yet: an empty table, not none
        if not spark.catalog.tableExists(f"{dbs['bronze']}.{name}"):
            load_all({name: empty_raw(spark, name)}, dbs["bronze"], fmt, _loc(root, "bronze"))
    act = _read(spark, dbs["bronze"], ACTIVITY)
    written.update(load_all(
        bronze_catalogue(spark, landing, act["bronze_play_history"], act["bronze_playlist_tracks"], mode, multi_line),
        dbs["bronze"], fmt, _loc(root, "bronze"), skip_empty=True))
    if mode == "PERMISSIVE":
        broken = bronze_corrupt(spark, landing, run_ts, window_hours, multi_line)
        written.update(load_all({"bronze_corrupt_pages": broken}, dbs["bronze"], fmt, _loc(root, "bronze")))
    for name in CATALOGUE:
        if not spark.catalog.tableExists(f"{dbs['bronze']}.{name}"):
            load_all({name: empty_raw(spark, name)}, dbs["bronze"], fmt, _loc(root, "bronze"))
    return written


def run_check(spark: SparkSession, landing: Mapping[str, str | list[str]], database: str = "tunestats",
              root: str | None = None, fmt: str = "parquet", mode: str = "FAILFAST", multi_line: bool = False) -> dict[str, int | None]:
    """What layer 1 lacks, as tables beside it: ``bronze_page_chains`` (how
    every chain of landed listing pages stands), ``bronze_track_requests`` and
    ``bronze_artist_requests`` (harvested ids without a catalogue row, fifty to
    a request), ``bronze_rest_fields`` (what landed pages hold beside their
    schemas) and ``bronze_rest_counts``. Runs after ``run_bronze``, whose
    tables it reads. Returns the rows of each, and ``broken_chains``."""
    dbs = _prepare(spark, database, root)
    folder = shared_dir(spark, root)
    raw = _read(spark, dbs["bronze"], RAW)
    tracks, artists = harvest_keys(raw["bronze_play_history"], raw["bronze_playlist_tracks"])
    links = reduce(DataFrame.unionByName, [read_links(spark, LANDING_KEYS[k], landing[k], mode, multi_line)
                                           for k in ("plays", "playlists", "playlist_tracks")])
    rest = reduce(DataFrame.unionByName, [read_rest(spark, LANDING_KEYS[k], path, multi_line) for k, path in landing.items()])
    written = load_all({
        "bronze_page_chains": page_chains(links, folder),
        "bronze_track_requests": missing_requests(tracks, raw["bronze_tracks"], "track_id", folder),
        "bronze_artist_requests": missing_requests(artists, raw["bronze_artists"], "artist_id", folder),
        "bronze_rest_fields": rest,
    }, dbs["bronze"], fmt, _loc(root, "bronze"))
    written |= load_all({"bronze_rest_counts": field_counts(spark.table(f"{dbs['bronze']}.bronze_rest_fields"))}, dbs["bronze"], fmt,
                        _loc(root, "bronze"))
    broken = spark.table(f"{dbs['bronze']}.bronze_page_chains").where("status <> 'complete'").count()
    return written | {"broken_chains": broken}


def run_silver(spark: SparkSession, database: str = "tunestats", root: str | None = None,
               fmt: str = "parquet", time_buckets: int | None = None) -> dict[str, int | None]:
    """Layer 2: stored raw tables → the star schema. With ``time_buckets`` the
    plays and ``dim_time`` are stored in that many buckets of their timestamp,
    so that they join without a shuffle. The plays' files hold the key's text;
    the name ``fct_plays`` hashes it as it is read."""
    dbs = _prepare(spark, database, root)
    raw = _read(spark, dbs["bronze"], RAW)
    folder = root or spark.conf.get("spark.checkpoint.dir", None)
    tables, buckets = silver_tables(raw, folder, unkeyed=True), None
    if time_buckets:
        buckets = {"fct_plays": ("play_timestamp", time_buckets, model.text_keyed_plays, parse_ts("played_at")),
                   "dim_time": ("play_timestamp", time_buckets)}
    else:
        tables["fct_plays"] = model.text_keyed_plays(tables["fct_plays"])
    return load_all(tables, dbs["silver"], fmt, _loc(root, "silver"), buckets=buckets,
                    views={"fct_plays": model.hashed_view(schemas.FCT_PLAYS)})


def run_gold(spark: SparkSession, database: str = "tunestats", root: str | None = None, fmt: str = "parquet",
             user_id: str = DEFAULT_USER, ordered: bool = False) -> dict[str, int | None]:
    """Layer 3: stored star schema → wide play table → aggregate tables
    (``ordered``: their files in the reference's row order)."""
    dbs = _prepare(spark, database, root)
    silver = _read(spark, dbs["silver"], SILVER)
    # the wide table holds the key's text where the plays do: the aggregates only count keys
    plays, view = stored(spark, f"{dbs['silver']}.fct_plays"), None
    if model.KEY_TEXT in plays.columns:
        plays, view = plays.withColumnRenamed(model.KEY_TEXT, "play_id"), {"base_analytics": model.hashed_view(schemas.BASE_ANALYTICS)}
    parts = marts.base_parts(plays if view else silver["fct_plays"], silver["dim_tracks"], silver["dim_artists"])
    written = load_all({"base_analytics": [p.withColumnRenamed("play_id", model.KEY_TEXT) for p in parts] if view else parts}, dbs["gold"], fmt,
                       _loc(root, "gold"), views=view)
    base = stored(spark, f"{dbs['gold']}.base_analytics").withColumnRenamed(model.KEY_TEXT, "play_id")
    written.update(load_all(gold_tables(base, user_id, silver["dim_artists"], ordered, silver["dim_tracks"]), dbs["gold"], fmt, _loc(root, "gold")))
    return written


def run(spark: SparkSession, landing: Mapping[str, str | list[str]], database: str = "tunestats",
        root: str | None = None, run_ts: str | datetime | None = None, window_hours: int = 24,
        fmt: str = "parquet", user_id: str = DEFAULT_USER,
        mode: str = "FAILFAST", multi_line: bool = False, time_buckets: int | None = None, ordered: bool = False) -> dict[str, dict[str, int | None]]:
    """Run all layers; returns rows written per table per layer.

    Tables go to the databases ``{database}_bronze`` / ``_silver`` /
    ``_gold``; with ``root`` their files live under ``root/<layer>/<table>``
    (shared storage on a cluster). Each layer reads only the stored tables
    of the layer before it, so the three can also run as separate jobs."""
    written = {
        "bronze": run_bronze(spark, landing, database, root, run_ts, window_hours, fmt, mode, multi_line),
        "silver": run_silver(spark, database, root, fmt, time_buckets),
    }
    gold = run_gold(spark, database, root, fmt, user_id, ordered)
    written["base"] = {"base_analytics": gold.pop("base_analytics")}
    written["gold"] = gold
    return written
