"""


Every query reads the driver's tables whole and derives the pipeline's
inputs from them with Spark (``tunestats.fixtures``); nothing runs on
made-up or fixed small input. Results are shown with one convention on both
sides (``_present``): timestamps as text, arrays as JSON text, decimal
minutes as DOUBLE.
"""

from __future__ import annotations

import os
import re
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import ArrayType, DecimalType, TimestampNTZType, TimestampType  # noqa: E402

from tunestats import fixtures as fx  # noqa: E402
from tunestats import oracle, schemas  # noqa: E402
from tunestats.operators import in_order  # noqa: E402
from tunestats.plans import distincts, marts, model, pipeline, refresh, reports  # noqa: E402
from tunestats.session import apply_scale_conf, shared_dir  # noqa: E402
from tunestats.sinks import Layer, ensure_schema, in_file_order, load_all, open_layer, publish, stored, write_parts, write_with_schema  # noqa: E402
from tunestats.sources import (  # noqa: E402
    enrich,
    field_counts,
    harvest_keys,
    missing_requests,
    page_chains,
    parse_links,
    recent,
    rest_of_pages,
)
from tunestats.streaming import keep_up  # noqa: E402

try:  # the training-data queries: only where their subpackage is there
    import corpus_pipeline
    from tunestats.llm import registry as llm
except ModuleNotFoundError as missing:
    if not re.match(r"corpus_pipeline$|tunestats\.llm\b", missing.name or ""):
        raise
    llm = corpus_pipeline = None

TIME_BUCKETS = 8                  # of the stored plays and dim_time, at least
BUCKET_PLAYS = 2_000_000          # plays in one of them, about: a task sorts one in memory
LIVE_BATCHES = 3                  # micro-batches of the stream's stand-in
RUN_TS = "2024-01-16T00:00:00Z"   # fixed ingestion instant for recent_plays


def _present(df: DataFrame) -> DataFrame:
    """Timestamps → text, arrays → JSON text, decimals → DOUBLE."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, ArrayType):
            c = F.to_json(c)
        elif isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ------------------------------------------------------------ builders --
_STORED: dict[tuple[str, str], str] = {}


def _lazy_base(spark: SparkSession, d: str, holes: bool = True) -> DataFrame:
    """The wide play table in one plan, from the raw stand-ins."""
    return marts.base_analytics(model.fct_plays(fx.plays_li(spark, d)), model.dim_tracks(fx.tracks_raw(spark, d, holes)),
                                model.dim_artists(fx.artists_raw(spark, d, holes)))


def _time_buckets(plays: int) -> int:
    return max(TIME_BUCKETS, -(-plays // BUCKET_PLAYS))


def _stored(spark: SparkSession, d: str) -> str:
    """The path that ships: land the pages of every kind, run the three
    layers, and return the prefix of the databases that hold their tables.
    Run once for each application and input folder; marts, reports and tiles
    then read the stored tables, as their users do."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _STORED:
        run = uuid.uuid4().hex
        root = f"{shared_dir(spark)}/stored-{run}"
        pipeline.run(spark, fx.land(spark, d, f"{root}/landing"), f"tunestats_{run}", f"{root}/tables",
                     time_buckets=_time_buckets(fx.table(spark, d, "lineitem").count()), ordered=True)
        _STORED[key] = f"tunestats_{run}"
    return _STORED[key]


_LIVE: dict[tuple[str, str], Layer] = {}


def _live(spark: SparkSession, d: str) -> Layer:
    """Fact and aggregates as a stream keeps them up: the play pages of the
    stand-in land as files and arrive in several micro-batches."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _LIVE:
        run = uuid.uuid4().hex
        root, db = f"{shared_dir(spark)}/live-{run}", f"tunestats_live_{run}"
        fx.land_pages(fx.play_pages_li(spark, d), f"{root}/landing")
        files = len(spark.read.text(f"{root}/landing").inputFiles())
        keep_up(spark, f"{root}/landing", _silver(spark, d, "dim_tracks"), _silver(spark, d, "dim_artists"), db, f"{root}/tables",
                f"{root}/checkpoint", max_files_per_trigger=-(-files // LIVE_BATCHES)).awaitTermination()
        _LIVE[key] = open_layer(spark, db, f"{root}/tables")
    return _LIVE[key]


def _bronze(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.table(f"{_stored(spark, d)}_bronze.{name}")


def _silver(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.table(f"{_stored(spark, d)}_silver.{name}")


def _gold(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.table(f"{_stored(spark, d)}_gold.{name}")


def _base(spark: SparkSession, d: str) -> DataFrame:
    return _gold(spark, d, "base_analytics")


def _time_join(spark: SparkSession, d: str) -> DataFrame:
    """The wide table with its time attributes from the stored dim_time. The key
    is joined as the text that is stored, and hashed last."""
    plays = stored(spark, f"{_stored(spark, d)}_silver.fct_plays").withColumnRenamed(model.KEY_TEXT, "play_id")
    parts = marts.base_parts(plays, *(_silver(spark, d, t) for t in ("dim_tracks", "dim_artists", "dim_time")))
    if len(parts) > 1:
        path = f"{shared_dir(spark)}/time-join-{uuid.uuid4().hex}"
        write_parts(parts, path)
        parts = [spark.read.parquet(path)]
    return parts[0].withColumnRenamed("play_id", model.KEY_TEXT).selectExpr(*model.hashed_view(schemas.BASE_ANALYTICS))


def _positioned(df: DataFrame) -> DataFrame:
    """The place of every row in the order that the frame itself has."""
    return in_order(df, shared_dir(df.sparkSession)).withColumn("position", F.col("position").cast("int"))


def _in_files(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A stored gold table with the place of every row in its files."""
    return in_file_order(spark, f"{_stored(spark, d)}_gold.{name}").withColumn("position", F.col("position").cast("int"))


def _relanded(df: DataFrame, key: str, name: str) -> DataFrame:
    """The rows, and some of them once more with another name (fixed rule by
    the key's last character): smaller, larger or missing."""
    last = F.substring(key, -1, 1)
    other = F.when(last == "1", F.concat(F.lit("!"), name)).when(last == "4", F.concat(F.col(name), F.lit("~")))
    return df.unionByName(df.where(last.isin("1", "4", "7")).withColumn(name, other))


def _overwrite_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Publish twice under one name: the fact, then fewer rows of another schema."""
    run = uuid.uuid4().hex
    root = f"{shared_dir(spark)}/overwrite-{run}"
    ensure_schema(spark, "tunestats_roundtrip", location=f"{root}/db")
    name = f"tunestats_roundtrip.overwritten_{run}"
    publish(spark, model.fct_plays(fx.plays_li(spark, d)), name, root=root)
    publish(spark, fx.playlists_raw(spark, d).select("playlist_id", "total_tracks"), name, root=root)
    return spark.table(name)


def _skip_empty_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """A raw table is loaded, then loaded again with nothing landed: it stays."""
    run = uuid.uuid4().hex
    root, name = f"{shared_dir(spark)}/skip-{run}", f"kept_{run}"
    ensure_schema(spark, "tunestats_roundtrip", location=f"{root}/db")
    raw = fx.playlists_raw(spark, d)
    for df in (raw, raw.limit(0)):
        load_all({name: df}, "tunestats_roundtrip", root=root, skip_empty=True)
    return spark.table(f"tunestats_roundtrip.{name}")


def _unique_tracks(spark: SparkSession, d: str) -> DataFrame:
    """Distinct tracks of each artist by month and in all, from the union of stored day bitmaps."""
    root, base = f"{shared_dir(spark)}/bitmaps-{uuid.uuid4().hex}", _base(spark, d)
    distincts.day_bitmaps(base, distincts.track_numbers(base, root)).write.parquet(f"{root}/days")
    days = spark.read.parquet(f"{root}/days")
    month = F.date_format("day", "yyyy-MM")
    by_month = distincts.unique_tracks(days, month).select("artist_id", F.lit("month").alias("span"), F.col("_by0").alias("month"), "unique_tracks")
    return by_month.unionByName(distincts.unique_tracks(days).select(
        "artist_id", F.lit("all").alias("span"), F.lit(None).cast("string").alias("month"), "unique_tracks"))


def _kpis(spark: SparkSession, d: str) -> DataFrame:
    return reports.report_kpis(_gold(spark, d, "gold_user_listening_summary"))


def _harvest(spark: SparkSession, d: str):
    return harvest_keys(fx.plays_ev(spark, d), fx.playlist_tracks_raw(spark, d))


def _write_read_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    run = uuid.uuid4().hex
    root = f"{shared_dir(spark)}/roundtrip-{run}"
    db = "tunestats_roundtrip"
    ensure_schema(spark, db, location=f"{root}/db")
    # a table per call, so no later call replaces files an earlier result reads
    load_all({f"fct_plays_{run}": model.fct_plays(fx.plays_li(spark, d))}, database=db, root=root)
    return spark.table(f"{db}.fct_plays_{run}")


def _write_with_schema_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    run = uuid.uuid4().hex
    root = f"{shared_dir(spark)}/schema-{run}"
    db = "tunestats_roundtrip"
    ensure_schema(spark, db, location=f"{root}/db")
    # extra column dropped, preview_url absent → typed NULL, columns reordered
    raw = fx.tracks_raw(spark, d).drop("preview_url").withColumn("extra", F.lit(1))
    write_with_schema(spark, raw.select(*reversed(raw.columns)), f"{db}.dim_tracks_{run}",
                      schemas.DIM_TRACKS, path=f"{root}/dim_tracks")
    return spark.table(f"{db}.dim_tracks_{run}")


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # sources
        "flatten_play_pages": lambda s, d: fx.plays_from_pages(s, d),
        "flatten_playlist_pages": lambda s, d: fx.playlists_from_pages(s, d),
        "flatten_playlist_item_pages": lambda s, d: fx.playlist_tracks_from_pages(s, d),
        "flatten_track_pages": lambda s, d: fx.tracks_from_pages(s, d),
        "flatten_artist_pages": lambda s, d: fx.artists_from_pages(s, d),
        "recent_plays": lambda s, d: recent(fx.plays_ev(s, d), RUN_TS, hours=24),
        "harvest_track_keys": lambda s, d: _harvest(s, d)[0],
        "harvest_artist_keys": lambda s, d: _harvest(s, d)[1],
        "enrich_tracks": lambda s, d: enrich(fx.tracks_raw(s, d), _harvest(s, d)[0], "track_id"),
        "enrich_artists": lambda s, d: enrich(fx.artists_raw(s, d), _harvest(s, d)[1], "artist_id"),
        "page_chains": lambda s, d: page_chains(parse_links(fx.linked_pages(s, d), "value"), shared_dir(s)),
        "missing_track_requests": lambda s, d: missing_requests(_harvest(s, d)[0], fx.tracks_raw(s, d), "track_id", shared_dir(s)),
        "missing_artist_requests": lambda s, d: missing_requests(_harvest(s, d)[1], fx.artists_raw(s, d), "artist_id", shared_dir(s)),
        "unknown_page_fields": lambda s, d: field_counts(
            rest_of_pages(fx.grown_track_pages(s, d), "value", schemas.TRACK_PAGE, ["kind"])),
        # model
        "dim_time": lambda s, d: model.dim_time(fx.plays_li(s, d)),
        "dim_tracks": lambda s, d: model.dim_tracks(_relanded(fx.tracks_raw(s, d).drop("preview_url"), "track_id", "track_name")),
        "dim_artists": lambda s, d: model.dim_artists(_relanded(fx.artists_raw(s, d), "artist_id", "artist_name")),
        "dim_playlists": lambda s, d: model.dim_playlists(
            _relanded(fx.playlists_raw(s, d).drop("followers"), "playlist_id", "playlist_name")),
        "fct_plays_ev": lambda s, d: model.fct_plays(fx.plays_ev(s, d)),
        "fct_plays_li": lambda s, d: model.fct_plays(fx.plays_li(s, d)),
        "fct_plays_repeats": lambda s, d: model.fct_plays(fx.plays_li(s, d), shared_dir(s)),
        # marts
        "base_analytics": lambda s, d: _lazy_base(s, d),
        "base_analytics_time_join": _time_join,
        "user_summary": lambda s, d: marts.user_summary(_base(s, d)),
        "user_summary_full_dims": lambda s, d: marts.user_summary(_lazy_base(s, d, holes=False)),
        "top_tracks": lambda s, d: marts.top_tracks(_base(s, d), tracks=_silver(s, d, "dim_tracks")),
        "top_artists": lambda s, d: marts.top_artists(_base(s, d), artists=_silver(s, d, "dim_artists")),
        "artist_unique_tracks": _unique_tracks,
        "genre_trends": lambda s, d: marts.genre_trends(_base(s, d)),
        "listening_patterns": lambda s, d: marts.listening_patterns(_base(s, d)),
        # the layers' stored tables
        "pipeline_bronze_plays": lambda s, d: _bronze(s, d, "bronze_play_history"),
        "pipeline_bronze_playlists": lambda s, d: _bronze(s, d, "bronze_playlists"),
        "pipeline_fct_plays": lambda s, d: _silver(s, d, "fct_plays"),
        "pipeline_base": _base,
        "pipeline_summary": lambda s, d: _gold(s, d, "gold_user_listening_summary"),
        "pipeline_top_tracks": lambda s, d: _gold(s, d, "gold_top_tracks"),
        "pipeline_top_artists": lambda s, d: _gold(s, d, "gold_top_artists"),
        "pipeline_genre_trends": lambda s, d: _gold(s, d, "gold_genre_trends"),
        "pipeline_listening_patterns": lambda s, d: _gold(s, d, "gold_listening_patterns"),
        # kept up by a stream of landed pages
        "live_fct_plays": lambda s, d: refresh.fct_plays(_live(s, d)),
        "live_genre_trends": lambda s, d: refresh.genre_trends(_live(s, d)),
        "live_listening_patterns": lambda s, d: refresh.listening_patterns(_live(s, d)),
        # their orders, as a column
        "top_tracks_ordered": lambda s, d: _positioned(reports.report_top_tracks(_gold(s, d, "gold_top_tracks"))),
        "top_artists_ordered": lambda s, d: _positioned(marts.top_artists(_base(s, d), ordered=True)),
        "genre_trends_ordered": lambda s, d: _positioned(marts.genre_trends(_base(s, d), ordered=True)),
        "listening_patterns_ordered": lambda s, d: _positioned(marts.listening_patterns(_base(s, d), ordered=True)),
        "tile_artist_minutes_ordered": lambda s, d: _positioned(
            reports.tile_artist_minutes(reports.report_top_artists(_gold(s, d, "gold_top_artists")))),
        "report_top_artists_ordered": lambda s, d: _positioned(reports.report_top_artists(_gold(s, d, "gold_top_artists"))),
        "report_day_parts_ordered": lambda s, d: _positioned(reports.report_day_parts(_gold(s, d, "gold_listening_patterns"))),
        "report_top_genres_ordered": lambda s, d: _positioned(reports.report_top_genres(_gold(s, d, "gold_genre_trends"))),
        "stored_top_tracks_order": lambda s, d: _in_files(s, d, "gold_top_tracks"),
        "stored_top_artists_order": lambda s, d: _in_files(s, d, "gold_top_artists"),
        "stored_genre_trends_order": lambda s, d: _in_files(s, d, "gold_genre_trends"),
        # reports
        "report_genre_trends": lambda s, d: reports.report_genre_trends(_gold(s, d, "gold_genre_trends")),
        "report_top_artists": lambda s, d: reports.report_top_artists(_gold(s, d, "gold_top_artists")),
        "report_top_tracks": lambda s, d: reports.report_top_tracks(_gold(s, d, "gold_top_tracks")),
        "report_day_parts": lambda s, d: reports.report_day_parts(_gold(s, d, "gold_listening_patterns")),
        "report_kpis": lambda s, d: reports.report_kpis(_gold(s, d, "gold_user_listening_summary")),
        "report_top_genres": lambda s, d: reports.report_top_genres(_gold(s, d, "gold_genre_trends")),
        # tiles
        "tile_genre_plays": lambda s, d: reports.tile_genre_plays(reports.report_genre_trends(_gold(s, d, "gold_genre_trends"))),
        "tile_artist_minutes": lambda s, d: reports.tile_artist_minutes(reports.report_top_artists(_gold(s, d, "gold_top_artists"))),
        "tile_track_plays": lambda s, d: reports.tile_track_plays(reports.report_top_tracks(_gold(s, d, "gold_top_tracks"))),
        "tile_heatmap": lambda s, d: reports.tile_heatmap(reports.report_day_parts(_gold(s, d, "gold_listening_patterns"))),
        "tile_favourites": lambda s, d: reports.tile_favourites(_kpis(s, d)),
        "tile_total_tracks": lambda s, d: reports.tile_total_tracks(_kpis(s, d)),
        "tile_total_minutes": lambda s, d: reports.tile_total_minutes(_kpis(s, d)),
        # sinks
        "write_read_roundtrip": _write_read_roundtrip,
        "write_with_schema_roundtrip": _write_with_schema_roundtrip,
        "overwrite_roundtrip": _overwrite_roundtrip,
        "skip_empty_roundtrip": _skip_empty_roundtrip,
    }
    return q


def _wrap(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_scale_conf(spark)
        return _present(fn(spark, sf_dir))
    return run


def entry(spark: SparkSession) -> DataFrame:
    """
    (parse, hash key, de-dup, two left joins, filter, decimal sum, group)."""
    return queries()["top_tracks"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {k: _wrap(v) for k, v in _queries().items()}
    return own | llm.QUERIES | {"pipeline": corpus_pipeline.run} if llm else own


def oracle_sql() -> dict[str, str]:
    own = oracle.statements()
    if not llm:
        return own
    return own | llm.SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

