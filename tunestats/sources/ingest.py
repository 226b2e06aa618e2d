"""Ingestion window, key harvest and enrichment (SRC-9 … SRC-12)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunestats.functions import parse_ts


def _ts_literal(run_ts: str | datetime) -> Column:
    if isinstance(run_ts, datetime):
        if run_ts.tzinfo is None:
            run_ts = run_ts.replace(tzinfo=timezone.utc)
        run_ts = run_ts.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    return F.lit(run_ts).cast("timestamp")


def window_start(run_ts: str | datetime, hours: int = 24) -> Column:
    """The instant after which a play belongs to the run."""
    return _ts_literal(run_ts) - F.make_dt_interval(F.lit(0), F.lit(hours))


def recent(plays: DataFrame, run_ts: str | datetime, hours: int = 24) -> DataFrame:
    """SRC-9: plays strictly after ``run_ts - hours`` (``run_ts`` is an
    explicit UTC instant, not the clock)."""
    return plays.where(parse_ts("played_at") > window_start(run_ts, hours))


def _present(c: Column) -> Column:
    return c.isNotNull() & (F.length(c) > 0)


def harvest_keys(plays: DataFrame, playlist_tracks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC-10: ids to enrich.

    Track ids of plays and playlist items; artist ids of the first artist of
    each play and of every artist of each playlist item. NULL / empty ids are
    dropped; each id appears once (``distinct`` = partial + final hash
    aggregate, so repeated ids are combined before the shuffle).
    """
    tracks = (plays.select("track_id")
              .unionByName(playlist_tracks.select("track_id"))
              .where(_present(F.col("track_id")))
              .distinct())
    artists = (plays.select("artist_id")
               .unionByName(playlist_tracks.select(F.explode("artist_ids").alias("artist_id")))
               .where(_present(F.col("artist_id")))
               .distinct())
    return tracks, artists


def enrich(catalogue: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """SRC-11: catalogue rows whose ``key`` was harvested (left semi join:
    no key columns added, no catalogue row repeated)."""
    return catalogue.join(keys.select(key), on=key, how="left_semi")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC-12: managed-table scan."""
    return spark.table(name)
