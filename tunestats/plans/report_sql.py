"""The reports and tiles as views over the stored gold tables.

Dashboards and ad-hoc users address results by name with SQL. The views are
made from the frames of ``reports.py``, so there is one statement of each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tunestats.plans import reports

#: report → gold table; tile → report.
REPORTS: dict[str, str] = {
    "report_genre_trends": "gold_genre_trends",
    "report_top_artists": "gold_top_artists",
    "report_top_tracks": "gold_top_tracks",
    "report_day_parts": "gold_listening_patterns",
    "report_kpis": "gold_user_listening_summary",
    "report_top_genres": "gold_genre_trends",
}
TILES: dict[str, str] = {
    "tile_genre_plays": "report_genre_trends",
    "tile_artist_minutes": "report_top_artists",
    "tile_track_plays": "report_top_tracks",
    "tile_heatmap": "report_day_parts",
    "tile_favourites": "report_kpis",
    "tile_total_tracks": "report_kpis",
    "tile_total_minutes": "report_kpis",
}


def frame(spark: SparkSession, name: str, gold: str) -> DataFrame:
    """A report or tile over the gold database ``gold``."""
    build: Callable[[DataFrame], DataFrame] = getattr(reports, name)
    if name in TILES:
        return build(frame(spark, TILES[name], gold))
    return build(spark.table(f"{gold}.{REPORTS[name]}"))


def register(spark: SparkSession, gold: str) -> list[str]:
    """Make every report and tile a view of the session; returns their names."""
    for name in (*REPORTS, *TILES):
        frame(spark, name, gold).createOrReplaceTempView(name)
    return [*REPORTS, *TILES]


def run_report(spark: SparkSession, name: str, gold: str) -> DataFrame:
    """A report or tile by name, through its view."""
    frame(spark, name, gold).createOrReplaceTempView(name)
    return spark.sql(f"SELECT * FROM {name}")
