"""Report queries (RPT-1 … RPT-6) and the data behind each report tile
(TIL-1 … TIL-7).

Ranking reports are ``ORDER BY … LIMIT n`` (a per-partition top-n, then a
merge of n rows per partition). The sort keys are the ranking column
followed by every other output column, so the n rows kept at a tie are the
same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunestats.functions import TOP_ARTISTS_ROWS, TOP_GENRES_ROWS, TOP_TRACKS_ROWS, day_part
from tunestats.operators import top_n


def report_genre_trends(genre_trends: DataFrame) -> DataFrame:
    """RPT-1."""
    return genre_trends.select("month", "genre", "total_plays", "avg_popularity")


def report_top_artists(top_artists: DataFrame, n: int = TOP_ARTISTS_ROWS) -> DataFrame:
    """RPT-2 / TOP-2: artists by listening time."""
    df = top_artists.select("artist_name", "total_minutes", "total_plays", "unique_tracks")
    return top_n(df, [F.desc("total_minutes"), F.asc_nulls_last("artist_name"),
                      F.desc("total_plays"), F.desc("unique_tracks")], n)


def report_top_tracks(top_tracks: DataFrame, n: int = TOP_TRACKS_ROWS) -> DataFrame:
    """RPT-3 / TOP-3: tracks by play count."""
    df = top_tracks.select("track_name", "artist_name", "play_count", "popularity")
    return top_n(df, [F.desc("play_count"), F.asc_nulls_last("track_name"),
                      F.asc_nulls_last("artist_name"), F.desc_nulls_last("popularity")], n)


def report_day_parts(patterns: DataFrame) -> DataFrame:
    """RPT-4: minutes by weekday and day part (weekday sorts as text)."""
    return (patterns.groupBy("weekday_name", day_part("hour_of_day").alias("time_period"))
            .agg(F.sum("total_minutes").alias("total_minutes"))
            .orderBy("weekday_name", "time_period"))


def report_kpis(summary: DataFrame) -> DataFrame:
    """RPT-5."""
    return summary.select("total_tracks", "unique_artists", "total_minutes", "favorite_artist", "top_track")


def report_top_genres(genre_trends: DataFrame, n: int = TOP_GENRES_ROWS) -> DataFrame:
    """RPT-6 / TOP-4: genres by plays over all months."""
    agg = genre_trends.groupBy("genre").agg(F.sum("total_plays").alias("total_plays"))
    return top_n(agg, [F.desc("total_plays"), F.asc_nulls_last("genre")], n)


# ---------------------------------------------------------------- tiles --
def tile_genre_plays(rpt: DataFrame) -> DataFrame:
    """TIL-1: plays per month per genre."""
    return rpt.select("genre", "month", "total_plays")


def tile_artist_minutes(rpt: DataFrame) -> DataFrame:
    """TIL-2 / SRT-4: minutes per artist, largest first."""
    return rpt.select("total_minutes", "artist_name").orderBy(F.desc("total_minutes"), F.asc_nulls_last("artist_name"))


def tile_track_plays(rpt: DataFrame) -> DataFrame:
    """TIL-3: plays per track."""
    return rpt.select("track_name", "play_count")


def tile_heatmap(rpt: DataFrame) -> DataFrame:
    """TIL-4: summed minutes per (weekday, day part)."""
    return (rpt.groupBy("weekday_name", "time_period")
            .agg(F.sum("total_minutes").alias("sum_total_minutes")))


def tile_favourites(rpt: DataFrame) -> DataFrame:
    """TIL-5: favourite artist and top track."""
    return rpt.select("top_track", "favorite_artist")


def tile_total_tracks(rpt: DataFrame) -> DataFrame:
    """TIL-6."""
    return rpt.agg(F.sum("total_tracks").alias("sum_total_tracks"))


def tile_total_minutes(rpt: DataFrame) -> DataFrame:
    """TIL-7."""
    return rpt.agg(F.sum("total_minutes").alias("sum_total_minutes"))
