"""Fixed schemas for every layer.

Nothing is inferred at load time: landed pages are parsed with the page
schemas below, and every raw, modelled and aggregate table is conformed to
its declared ``StructType`` before it is written.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, L, B, I, D, TS = StringType(), LongType(), BooleanType(), IntegerType(), DoubleType(), TimestampType()
MINUTES = DecimalType(38, 7)

# --------------------------------------------------------------------------
# Landed payload pages (one JSON document per line).
# --------------------------------------------------------------------------
_ARTIST_REF = _s(("id", S), ("name", S))
_ALBUM_REF = _s(("id", S), ("name", S))

PLAY_PAGE = _s(
    ("items", ArrayType(_s(
        ("played_at", S),
        ("track", _s(("id", S), ("name", S), ("duration_ms", L),
                     ("artists", ArrayType(_ARTIST_REF)), ("album", _ALBUM_REF))),
        ("context", _s(("type", S))),
    ))),
    ("next", S),
)

PLAYLIST_PAGE = _s(
    ("items", ArrayType(_s(
        ("id", S), ("name", S), ("description", S), ("snapshot_id", S),
        ("owner", _s(("display_name", S))),
        ("followers", _s(("total", L))),
        ("tracks", _s(("total", L))),
    ))),
    ("next", S),
)

# The playlist id is not part of an item page body (it is in the request
# path), so landed item pages carry it as a top-level column.
PLAYLIST_ITEM_PAGE = _s(
    ("playlist_id", S),
    ("items", ArrayType(_s(
        ("added_at", S),
        ("added_by", _s(("id", S))),
        ("track", _s(("id", S), ("name", S), ("duration_ms", L), ("popularity", L),
                     ("artists", ArrayType(_s(("id", S)))), ("album", _s(("id", S))))),
    ))),
    ("next", S),
)

TRACK_PAGE = _s(
    ("tracks", ArrayType(_s(
        ("id", S), ("name", S), ("preview_url", S), ("duration_ms", L), ("popularity", L),
        ("explicit", B), ("artists", ArrayType(_ARTIST_REF)),
        ("album", _s(("id", S), ("name", S), ("release_date", S))),
    ))),
)

ARTIST_PAGE = _s(
    ("artists", ArrayType(_s(
        ("id", S), ("name", S), ("uri", S), ("genres", ArrayType(S)),
        ("followers", _s(("total", L))), ("popularity", L),
    ))),
)

# What any page of a listing says of its place in it.
PAGE_LINK = _s(("href", S), ("next", S), ("previous", S))

# --------------------------------------------------------------------------
# Raw (bronze) tables.
# --------------------------------------------------------------------------
BRONZE_PLAY_HISTORY = _s(
    ("played_at", S), ("track_id", S), ("track_name", S), ("artist_id", S),
    ("artist_name", S), ("album_id", S), ("album_name", S), ("context_type", S),
    ("duration_ms", L),
)

BRONZE_PLAYLISTS = _s(
    ("playlist_id", S), ("playlist_name", S), ("owner_name", S), ("followers", L),
    ("total_tracks", L), ("description", S), ("snapshot_id", S),
)

BRONZE_PLAYLIST_TRACKS = _s(
    ("playlist_id", S), ("track_id", S), ("track_name", S), ("artist_ids", ArrayType(S)),
    ("album_id", S), ("added_at", S), ("added_by", S), ("duration_ms", L), ("popularity", L),
)

BRONZE_TRACKS = _s(
    ("track_id", S), ("track_name", S), ("album_id", S), ("album_name", S),
    ("artist_id", S), ("artist_name", S), ("duration_ms", L), ("popularity", L),
    ("explicit", B), ("release_date", S), ("preview_url", S),
)

BRONZE_ARTISTS = _s(
    ("artist_id", S), ("artist_name", S), ("genres", ArrayType(S)),
    ("followers", L), ("popularity", L), ("uri", S),
)

# --------------------------------------------------------------------------
# Modelled (silver) tables.
# --------------------------------------------------------------------------
DIM_TIME = _s(
    ("play_timestamp", TS), ("hour_of_day", I), ("day_of_week_num", I),
    ("weekday_name", S), ("month_name", S), ("quarter", I), ("year", I),
)
DIM_TRACKS = BRONZE_TRACKS
DIM_ARTISTS = BRONZE_ARTISTS
DIM_PLAYLISTS = BRONZE_PLAYLISTS
FCT_PLAYS = _s(
    ("play_id", S), ("play_timestamp", TS), ("track_id", S), ("artist_id", S),
    ("album_id", S), ("duration_ms", L), ("context_type", S),
)

# --------------------------------------------------------------------------
# Joined and aggregate (gold) tables.
# --------------------------------------------------------------------------
BASE_ANALYTICS = _s(
    ("play_id", S), ("play_timestamp", TS), ("duration_ms", L), ("context_type", S),
    ("track_id", S), ("track_name", S), ("popularity", L), ("artist_id", S),
    ("artist_name", S), ("genres", ArrayType(S)), ("hour_of_day", I),
    ("weekday_name", S), ("month", S),
)

GOLD_USER_SUMMARY = _s(
    ("user_id", S), ("total_tracks", L), ("unique_artists", L),
    ("total_minutes", MINUTES), ("favorite_artist", S), ("top_track", S),
)

GOLD_TOP_TRACKS = _s(
    ("track_id", S), ("track_name", S), ("artist_name", S), ("play_count", L),
    ("total_minutes", MINUTES), ("popularity", L),
)

GOLD_TOP_ARTISTS = _s(
    ("artist_id", S), ("artist_name", S), ("total_plays", L), ("unique_tracks", L),
    ("total_minutes", MINUTES), ("genres", ArrayType(S)),
)

GOLD_GENRE_TRENDS = _s(
    ("genre", S), ("month", S), ("total_plays", L), ("avg_popularity", D),
    ("unique_users", L),
)

GOLD_LISTENING_PATTERNS = _s(
    ("user_id", S), ("hour_of_day", I), ("weekday_name", S), ("total_minutes", MINUTES),
)

RAW_SCHEMAS = {
    "bronze_play_history": BRONZE_PLAY_HISTORY,
    "bronze_playlists": BRONZE_PLAYLISTS,
    "bronze_playlist_tracks": BRONZE_PLAYLIST_TRACKS,
    "bronze_tracks": BRONZE_TRACKS,
    "bronze_artists": BRONZE_ARTISTS,
}
