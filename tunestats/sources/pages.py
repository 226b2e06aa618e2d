"""Landed JSON payload pages → raw tables (SRC-1 … SRC-8, FLT-3).

A page is one JSON document per line, landed as fetched. Pages are read
with a fixed schema (no inference) in parallel by Spark, exploded to one
row per item and flattened by nested field access, which is NULL-safe by
construction (a missing object or field reads as NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tunestats import schemas
from tunestats.functions import first_or_null, nonempty_ids
from tunestats.operators import conform


#: Partition column of a landing folder that is laid out by day
#: (``.../land_date=2024-01-15/...``), and the column of a broken page's text.
LAND_DATE = "land_date"
CORRUPT = "_corrupt_record"


def read_pages(spark: SparkSession, path: str | list[str], schema: StructType,
               mode: str = "FAILFAST", multi_line: bool = False, since: Column | None = None) -> DataFrame:
    """Read landed pages with a fixed schema: JSON Lines (one page per line,
    files split across tasks), or with ``multi_line`` one document per file
    as an API returns it (one task per file).

    ``FAILFAST`` (default) fails the job on a malformed page instead of
    loading partial data; ``PERMISSIVE`` keeps going and reads a broken page
    as a page with no items (``corrupt_pages`` returns its text).

    ``since`` is the first day to read of a folder that is landed by day: a
    filter on the partition column, so earlier days are not listed or read.
    """
    df = spark.read.schema(schema).option("mode", mode).option("multiLine", multi_line).json(path)
    if LAND_DATE in df.columns:
        if since is not None:
            df = df.where(F.col(LAND_DATE) >= since)
        df = df.drop(LAND_DATE)
    return df


def corrupt_pages(spark: SparkSession, table: str, path: str | list[str], multi_line: bool = False,
                  since: Column | None = None) -> DataFrame:
    """(kind, page, empty): the text of every landed page that is not of its
    kind's form; ``empty`` if nothing of it could be read. This is a reading of
    the landing by itself: the raw tables come from another."""
    schema, _ = PAGE_KINDS[table]
    marked = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    pages = read_pages(spark, path, marked, "PERMISSIVE", multi_line, since)
    # a page column is named too: Spark does not read the text alone
    return pages.where(F.col(CORRUPT).isNotNull()).select(
        F.lit(table).alias("kind"), F.col(CORRUPT).alias("page"), F.col(schema.fieldNames()[0]).isNull().alias("empty"))


def parse_pages(df: DataFrame, text_col: str, schema: StructType, keep: list[str] | None = None,
                mode: str = "FAILFAST") -> DataFrame:
    """Parse a column of page text (e.g. a landed-text table or a stream
    value) with a fixed schema; ``keep`` columns are carried alongside."""
    parsed = F.from_json(F.col(text_col), schema, {"mode": mode}).alias("_page")
    return df.select(*(keep or []), parsed).select(*(keep or []), "_page.*")


def _items(pages: DataFrame, array_col: str, keep: list[str] | None = None) -> DataFrame:
    """Explode a page array to one row per item, dropping NULL items (FLT-3)."""
    keep = keep or []
    return (pages.select(*keep, F.explode(F.col(array_col)).alias("it"))
            .where(F.col("it").isNotNull()))


def _present(c: Column) -> Column:
    """Python truthiness of an id: not NULL and not empty."""
    return c.isNotNull() & (F.length(c) > 0)


def flatten_play_history(pages: DataFrame) -> DataFrame:
    """SRC-1: one row per played item; first artist only; items whose track
    is missing are kept with NULL track fields."""
    it, t = F.col("it"), F.col("it.track")
    artist = first_or_null(t.getField("artists"))
    out = _items(pages, "items").select(
        it.getField("played_at").alias("played_at"),
        t.getField("id").alias("track_id"),
        t.getField("name").alias("track_name"),
        artist.getField("id").alias("artist_id"),
        artist.getField("name").alias("artist_name"),
        t.getField("album").getField("id").alias("album_id"),
        t.getField("album").getField("name").alias("album_name"),
        it.getField("context").getField("type").alias("context_type"),
        t.getField("duration_ms").alias("duration_ms"),
    )
    return conform(out, schemas.BRONZE_PLAY_HISTORY)


def flatten_playlists(pages: DataFrame) -> DataFrame:
    """SRC-2: playlists with an id; owner name, track total and the
    follower total when the payload has one."""
    it = F.col("it")
    out = _items(pages, "items").where(_present(it.getField("id"))).select(
        it.getField("id").alias("playlist_id"),
        it.getField("name").alias("playlist_name"),
        it.getField("owner").getField("display_name").alias("owner_name"),
        it.getField("followers").getField("total").alias("followers"),
        it.getField("tracks").getField("total").alias("total_tracks"),
        it.getField("description").alias("description"),
        it.getField("snapshot_id").alias("snapshot_id"),
    )
    return conform(out, schemas.BRONZE_PLAYLISTS)


def flatten_playlist_tracks(pages: DataFrame) -> DataFrame:
    """SRC-3 / SRC-8: playlist items with a track id; ``artist_ids`` holds
    every non-empty artist id of the track (empty array when none)."""
    it, t = F.col("it"), F.col("it.track")
    ids = F.coalesce(nonempty_ids(t.getField("artists")), F.array().cast(ArrayType(StringType())))
    out = _items(pages, "items", keep=["playlist_id"]).where(_present(t.getField("id"))).select(
        F.col("playlist_id"),
        t.getField("id").alias("track_id"),
        t.getField("name").alias("track_name"),
        ids.alias("artist_ids"),
        t.getField("album").getField("id").alias("album_id"),
        it.getField("added_at").alias("added_at"),
        it.getField("added_by").getField("id").alias("added_by"),
        t.getField("duration_ms").alias("duration_ms"),
        t.getField("popularity").alias("popularity"),
    )
    return conform(out, schemas.BRONZE_PLAYLIST_TRACKS)


def flatten_tracks(pages: DataFrame) -> DataFrame:
    """SRC-4: track catalogue rows; first artist, album fields."""
    t = F.col("it")
    artist = first_or_null(t.getField("artists"))
    album = t.getField("album")
    out = _items(pages, "tracks").select(
        t.getField("id").alias("track_id"),
        t.getField("name").alias("track_name"),
        album.getField("id").alias("album_id"),
        album.getField("name").alias("album_name"),
        artist.getField("id").alias("artist_id"),
        artist.getField("name").alias("artist_name"),
        t.getField("duration_ms").alias("duration_ms"),
        t.getField("popularity").alias("popularity"),
        t.getField("explicit").alias("explicit"),
        album.getField("release_date").alias("release_date"),
        t.getField("preview_url").alias("preview_url"),
    )
    return conform(out, schemas.BRONZE_TRACKS)


def flatten_artists(pages: DataFrame) -> DataFrame:
    """SRC-5: artist catalogue rows; genres array, follower total."""
    a = F.col("it")
    out = _items(pages, "artists").select(
        a.getField("id").alias("artist_id"),
        a.getField("name").alias("artist_name"),
        a.getField("genres").alias("genres"),
        a.getField("followers").getField("total").alias("followers"),
        a.getField("popularity").alias("popularity"),
        a.getField("uri").alias("uri"),
    )
    return conform(out, schemas.BRONZE_ARTISTS)


# Readers: path of landed pages → raw table DataFrame.
PAGE_KINDS = {
    "bronze_play_history": (schemas.PLAY_PAGE, flatten_play_history),
    "bronze_playlists": (schemas.PLAYLIST_PAGE, flatten_playlists),
    "bronze_playlist_tracks": (schemas.PLAYLIST_ITEM_PAGE, flatten_playlist_tracks),
    "bronze_tracks": (schemas.TRACK_PAGE, flatten_tracks),
    "bronze_artists": (schemas.ARTIST_PAGE, flatten_artists),
}


def read_raw(spark: SparkSession, table: str, path: str | list[str], mode: str = "FAILFAST",
             multi_line: bool = False, since: Column | None = None) -> DataFrame:
    """Read one kind of landed page and flatten it to its raw table."""
    schema, flatten = PAGE_KINDS[table]
    return flatten(read_pages(spark, path, schema, mode, multi_line, since))


def read_play_history(spark: SparkSession, path, mode: str = "FAILFAST") -> DataFrame:
    return read_raw(spark, "bronze_play_history", path, mode)


def read_playlists(spark: SparkSession, path, mode: str = "FAILFAST") -> DataFrame:
    return read_raw(spark, "bronze_playlists", path, mode)


def read_playlist_tracks(spark: SparkSession, path, mode: str = "FAILFAST") -> DataFrame:
    return read_raw(spark, "bronze_playlist_tracks", path, mode)


def read_tracks(spark: SparkSession, path, mode: str = "FAILFAST") -> DataFrame:
    return read_raw(spark, "bronze_tracks", path, mode)


def read_artists(spark: SparkSession, path, mode: str = "FAILFAST") -> DataFrame:
    return read_raw(spark, "bronze_artists", path, mode)
