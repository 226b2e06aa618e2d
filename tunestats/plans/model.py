"""Modelled tables: the star schema (TBL-1 … TBL-5).

Pure ``DataFrame → DataFrame`` builders; writing is the pipeline's job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tunestats import schemas
from tunestats.functions import (
    PLAY_KEY_BITS,
    day_of_week_num,
    hour_of_day,
    month_name,
    parse_ts,
    play_key,
    play_key_text,
    quarter,
    weekday_name,
    year,
)
from tunestats.operators import add_missing, conform, dedupe, dedupe_repeats, distinct_rows


def dim_time(plays_raw: DataFrame) -> DataFrame:
    """TBL-1: one row per distinct play timestamp (one NULL row when some
    ``played_at`` is missing or malformed) with calendar attributes."""
    ts = distinct_rows(plays_raw.select(parse_ts("played_at").alias("play_timestamp")))
    out = ts.select(
        "play_timestamp",
        hour_of_day("play_timestamp").alias("hour_of_day"),
        day_of_week_num("play_timestamp").alias("day_of_week_num"),
        weekday_name("play_timestamp").alias("weekday_name"),
        month_name("play_timestamp").alias("month_name"),
        quarter("play_timestamp").alias("quarter"),
        year("play_timestamp").alias("year"),
    )
    return conform(out, schemas.DIM_TIME)


def _one_row_each(df: DataFrame, key: str, root: str | None) -> DataFrame:
    """One row per ``key``; with ``root`` (a shared folder, for stored rows that
    can be read again) rows whose key occurs once stay where they are."""
    return dedupe_repeats(df, [key], root) if root else dedupe(df, [key])


def dim_tracks(tracks_raw: DataFrame, root: str | None = None) -> DataFrame:
    """TBL-2: one row per ``track_id``; ``preview_url`` kept as a typed NULL
    when the source lacks it. ``root``: see ``fct_plays``."""
    df = add_missing(tracks_raw, "preview_url", schemas.S)
    return _one_row_each(conform(df, schemas.DIM_TRACKS), "track_id", root)


# Survivor order for artists: scalar columns first, the genre list last.
_ARTIST_ORDER = ["artist_name", "followers", "popularity", "uri", "genres"]


def dim_artists(artists_raw: DataFrame) -> DataFrame:
    """TBL-3: one row per ``artist_id``."""
    df = conform(artists_raw, schemas.DIM_ARTISTS)
    return dedupe(df, ["artist_id"], _ARTIST_ORDER)


def dim_playlists(playlists_raw: DataFrame, root: str | None = None) -> DataFrame:
    """TBL-4: one row per ``playlist_id``; ``followers`` kept as a typed
    NULL when the source lacks it. ``root``: see ``fct_plays``."""
    df = add_missing(playlists_raw, "followers", schemas.L)
    return _one_row_each(conform(df, schemas.DIM_PLAYLISTS), "playlist_id", root)


#: The column that stored plays hold instead of ``play_id``: the key's text,
#: which files compress to some bytes (the hash's 32 they cannot).
KEY_TEXT = "play_key"


def play_rows(plays_raw: DataFrame) -> DataFrame:
    """Every raw play with ``played_at`` and the columns of the fact that are
    not made of it: what goes through a shuffle."""
    kept = [f for f in schemas.FCT_PLAYS if f.name not in ("play_id", "play_timestamp")]
    return plays_raw.select(F.col("played_at").cast("string"), *[F.col(f.name).cast(f.dataType) for f in kept])


def unkeyed_plays(plays_raw: DataFrame, root: str | None = None) -> DataFrame:
    """The rows of ``fct_plays`` with ``played_at`` instead of the key and
    the time, which ``text_keyed_plays`` or ``keyed_plays`` put on after a shuffle."""
    df = play_rows(plays_raw)
    # duplicates are found by the key's text, which is shorter than its
    # hash; equal texts are equal keys, and NULL stays NULL
    wide = df.select(play_key_text("played_at", "track_id").alias("_key"), parse_ts("played_at").alias("play_timestamp"), "*")
    # of one key, ``played_at`` follows from ``track_id``: it decides nothing
    order = [f.name for f in schemas.FCT_PLAYS if f.name != "play_id"] + ["played_at"]
    return (dedupe_repeats(wide, ["_key"], root, order) if root else dedupe(wide, ["_key"], order)).select(*df.columns)


def text_keyed_plays(rows: DataFrame) -> DataFrame:
    """``unkeyed_plays`` with the key's text in place of its hash (``KEY_TEXT``)."""
    out = rows.withColumns({KEY_TEXT: play_key_text("played_at", "track_id"), "play_timestamp": parse_ts("played_at")})
    return conform(out.withColumnRenamed(KEY_TEXT, "play_id"), schemas.FCT_PLAYS).withColumnRenamed("play_id", KEY_TEXT)


def keyed_plays(rows: DataFrame) -> DataFrame:
    """``unkeyed_plays`` as TBL-5."""
    out = rows.withColumns({"play_id": play_key("played_at", "track_id"), "play_timestamp": parse_ts("played_at")})
    return conform(out, schemas.FCT_PLAYS)


def hashed_view(schema: StructType) -> list[str]:
    """What the published name of a table stored with ``KEY_TEXT`` selects:
    the columns of ``schema``, the key hashed as it is read."""
    return [f"sha2({KEY_TEXT}, {PLAY_KEY_BITS}) AS play_id" if f.name == "play_id" else f.name for f in schema]


def fct_plays(plays_raw: DataFrame, root: str | None = None) -> DataFrame:
    """TBL-5: one row per play key ``sha2(played_at || track_id)``.

    With ``root`` (a shared folder, for plays that are stored and can be read
    again) only plays whose key occurs again are sorted and compared
    (``operators.dedupe_repeats``); the rows are the same.

    A play with a NULL ``played_at`` or ``track_id`` has a NULL key; all of
    them collapse into one row (as the key is NULL, not as the plays are
    equal)."""
    return keyed_plays(unkeyed_plays(plays_raw, root))
