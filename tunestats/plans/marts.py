"""The wide play table and the aggregate tables (TBL-6 … TBL-11).

Each aggregate is one grouped aggregate over ``base_analytics`` with
map-side partial aggregation, so hot groups (one artist, one genre, the
NULL artist of unmatched plays) are combined before the shuffle. Tables are
not sorted before they are written unless asked for; pass ``ordered=True`` to
get the reference's row order, with ties decided by the other columns. Stored
that way, ``sinks.in_file_order`` reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunestats import schemas
from tunestats.functions import DEFAULT_USER, hour_of_day, minutes, month_bucket, weekday_name
from tunestats.operators import (
    broadcast_bound,
    broadcast_parts,
    conform,
    explode_genres,
    fits_broadcast,
    in_part,
    left_join_dim,
    stitch_rows,
    top1_by_count,
    unless_large,
)


_SESSION_BOUND = object()


def base_analytics(fct: DataFrame, tracks: DataFrame, artists: DataFrame, time: DataFrame | None = None,
                   broadcast_max_bytes=_SESSION_BOUND) -> DataFrame:
    """TBL-6 / JN-5: plays left-joined to tracks, artists and time.

    ``track_id`` / ``artist_id`` are the dimension's keys (NULL when the
    play has no catalogue row). The time attributes are a pure function of
    ``play_timestamp``; by default they are derived in place, which equals
    the left join to ``dim_time`` (one row per timestamp, NULL never
    matches) without shuffling the fact against a fact-sized dimension.
    Pass ``time`` to take them from a ``dim_time`` table instead (JN-3): where
    both tables are stored in buckets of ``play_timestamp``
    (``pipeline.run_silver(time_buckets=...)``), neither side is shuffled. Plays
    without a timestamp match nothing and take no part in that join.

    ``broadcast_max_bytes`` defaults to the session's bound
    (``operators.broadcast_bound``); see ``operators.left_join_dim``.
    """
    if broadcast_max_bytes is _SESSION_BOUND:
        broadcast_max_bytes = broadcast_bound(fct.sparkSession)
    f = fct.select("play_id", "play_timestamp", "duration_ms", "context_type", "track_id", "artist_id")
    t = tracks.select("track_id", "track_name", "popularity")
    a = artists.select("artist_id", "artist_name", "genres")
    if time is not None:
        # first, while the fact still lies in the buckets that it is stored in
        tm = time.select("play_timestamp", "hour_of_day", "weekday_name").where(F.col("play_timestamp").isNotNull())
        unknown = {c: F.lit(None).cast(time.schema[c].dataType) for c in ("hour_of_day", "weekday_name")}
        tm = unless_large(tm, broadcast_max_bytes)
        f = (f.where(F.col("play_timestamp").isNotNull()).join(tm, on="play_timestamp", how="left")
             .unionByName(f.where(F.col("play_timestamp").isNull()).withColumns(unknown)))
    j = left_join_dim(f, t, "track_id", broadcast_max_bytes)
    j = left_join_dim(j, a, "artist_id", broadcast_max_bytes)
    if time is None:
        j = j.withColumns({
            "hour_of_day": hour_of_day("play_timestamp"),
            "weekday_name": weekday_name("play_timestamp"),
        })
    return conform(j.withColumn("month", month_bucket("play_timestamp")), schemas.BASE_ANALYTICS)


def base_parts(fct: DataFrame, tracks: DataFrame, artists: DataFrame, time: DataFrame | None = None) -> list[DataFrame]:
    """``base_analytics`` in parts to be written one after the other
    (``sinks.load_all``): one, unless the tracks are beyond the session's broadcast
    bound. Then each part has the plays and the tracks of some of the track ids, and
    its tracks can be broadcast: the plays are read once more for each part, and
    not dealt out. Beyond ``operators.MAX_PARTS`` it is one part, by a shuffle."""
    n = broadcast_parts(tracks.select("track_id", "track_name", "popularity"), broadcast_bound(fct.sparkSession))
    if n == 1:
        return [base_analytics(fct, tracks, artists, time)]
    return [base_analytics(*(df.where(in_part("track_id", i, n)) for df in (fct, tracks)), artists, time) for i in range(n)]


def _minutes_sum() -> F.Column:
    return F.sum(minutes("duration_ms"))


def user_summary(base: DataFrame, user_id: str = DEFAULT_USER) -> DataFrame:
    """TBL-7: one row: plays, distinct artists, minutes, favourite artist and
    top track (arg-max by plays, NULL names compete; ties go to the smaller
    name). Empty when there are no plays, as a cross product with an empty
    top-1 would be."""
    totals = base.agg(
        F.count("play_id").alias("total_tracks"),
        F.count_distinct("artist_id").alias("unique_artists"),
        _minutes_sum().alias("total_minutes"),
    ).select(F.lit(user_id).alias("user_id"), "*")
    fav = top1_by_count(base, "artist_name", "favorite_artist").select("favorite_artist")
    top = top1_by_count(base, "track_name", "top_track").select("top_track")
    return stitch_rows([totals, fav, top], schemas.GOLD_USER_SUMMARY)


def top_tracks(base: DataFrame, ordered: bool = False, tracks: DataFrame | None = None) -> DataFrame:
    """TBL-8: per (track_id, track_name, artist_name) of matched plays.

    Name and popularity come from the one ``dim_tracks`` row of ``track_id``.
    With ``tracks`` (that dimension) they are joined to the result, and the
    shuffles of plays and of the order carry neither; where it is too large to be
    broadcast, those that ``base`` holds are carried, which is a shuffle less."""
    bound = broadcast_bound(base.sparkSession)
    dim = None if tracks is None else tracks.select("track_id", "track_name", "popularity")
    fits = dim is not None and bound >= 0 and fits_broadcast(dim, bound)
    if bound >= 0 and not fits:
        tracks = None
    keys = ["track_id", "artist_name"] if tracks is not None else ["track_id", "track_name", "artist_name"]
    sums = [F.count("play_id").alias("play_count"), _minutes_sum().alias("total_minutes")]
    if tracks is None:
        sums.append(F.max("popularity").alias("popularity"))
    out = base.where(F.col("track_id").isNotNull()).groupBy(*keys).agg(*sums)
    order, dealt = [F.desc("play_count"), "track_id", "track_name", "artist_name"], False
    if tracks is not None:
        # a broadcast join leaves rows where they are: they are dealt out in order before they are wide
        dealt = ordered and fits
        if dealt:
            out = out.repartitionByRange(F.desc("play_count"), "track_id", "artist_name")
        out = left_join_dim(out, F.broadcast(dim) if fits else dim, "track_id", None if fits else bound)
    out = conform(out, schemas.GOLD_TOP_TRACKS)
    return out if not ordered else out.sortWithinPartitions(*order) if dealt else out.orderBy(*order)


def top_artists(base: DataFrame, ordered: bool = False, artists: DataFrame | None = None) -> DataFrame:
    """TBL-9: per (artist_id, artist_name) of plays with a known artist,
    with the artist's genres.

    In ``base_analytics`` name and genre list come from the one ``dim_artists``
    row of ``artist_id``, so both are constant per group. With ``artists``
    (that dimension) the plays are aggregated by id alone and the two
    attributes are joined to the result last: no name and no genre list goes
    through the plays' shuffles, and the one by artist and track carries no
    sums. Without it they are grouping keys, which
    gives the same rows as ``FIRST(genres)`` with fixed-width buffers, so all
    stages are hash aggregates either way."""
    known = base.where(F.col("artist_id").isNotNull())
    sums = [F.count("play_id").alias("total_plays"), _minutes_sum().alias("total_minutes")]
    if artists is not None:
        tracks = (known.where(F.col("track_id").isNotNull()).select("artist_id", "track_id").distinct()
                  .groupBy("artist_id").agg(F.count(F.lit(1)).alias("unique_tracks")))
        out = (known.groupBy("artist_id").agg(*sums).join(tracks, "artist_id", "left").na.fill(0, ["unique_tracks"])
               .join(unless_large(artists.select("artist_id", "artist_name", "genres"), broadcast_bound(base.sparkSession)), "artist_id"))
    else:
        out = known.groupBy("artist_id", "artist_name", "genres").agg(*sums, F.count_distinct("track_id").alias("unique_tracks"))
    out = conform(out, schemas.GOLD_TOP_ARTISTS)
    return out.orderBy(F.desc("total_plays"), "artist_id", "artist_name") if ordered else out


def genre_trends(base: DataFrame, user_id: str = DEFAULT_USER, ordered: bool = False) -> DataFrame:
    """TBL-10: per (genre, month): a play with n genres counts n times;
    plays with no genres drop out; ``avg_popularity`` is play-weighted."""
    g = explode_genres(base, keep=["play_id", "popularity", "month"]).where(F.col("genre").isNotNull())
    out = (g.groupBy("genre", "month")
           .agg(F.count("play_id").alias("total_plays"),
                F.avg("popularity").alias("avg_popularity"),
                F.count_distinct(F.lit(user_id)).alias("unique_users")))
    out = conform(out, schemas.GOLD_GENRE_TRENDS)
    return out.orderBy("month", F.desc("total_plays"), "genre") if ordered else out


def listening_patterns(base: DataFrame, user_id: str = DEFAULT_USER, ordered: bool = False) -> DataFrame:
    """TBL-11: minutes per (hour of day, weekday) for the one user; all
    plays count, matched or not."""
    out = (base.groupBy(F.lit(user_id).alias("user_id"), "hour_of_day", "weekday_name")
           .agg(_minutes_sum().alias("total_minutes")))
    out = conform(out, schemas.GOLD_LISTENING_PATTERNS)
    return out.orderBy("hour_of_day", "weekday_name") if ordered else out
