"""Stand-in inputs derived from the driver's tables (tests and bench only).

The driver's parquet tables hold no listening data, so every input of the
pipeline is derived from them with Spark (the derived work grows with the
tables):

* plays ``ev``: one play per ``events`` row (real clock times, hours and
  weekdays).
* plays ``li``: one play per ``lineitem`` row (volume, many months, real
  duplicate play keys since ``played_at`` and ``track_id`` are functions of
  ``(l_shipdate, l_partkey)``, plus a few missing / malformed times).
* track catalogue pages from ``part``, artist pages from ``supplier`` +
  ``nation`` + ``region``, playlist pages from ``orders`` and playlist item
  pages from ``lineitem``; each page holds at most 50 items, is serialised
  with ``to_json`` and parsed back with the fixed page schema.

Catalogue "holes" (an id the catalogue answers with null) give plays with no
track or artist row, i.e. the NULL side of the star join. They are part of
the fixture's meaning, not a way to make any check cheaper.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from tunestats import schemas
from tunestats.sources import (
    flatten_artists,
    flatten_play_history,
    flatten_playlist_tracks,
    flatten_playlists,
    flatten_tracks,
    parse_pages,
)

# Fixed fixture rules (the oracle SQL in __spark_entry__ states the same).
PAGE_SIZE = 50                 # items per landed page
EV_ARTISTS = 20                # ev plays: artist id = k % 20
TRACK_HOLE = (10, 3)           # part key % 10 = 3: track page answers null
ARTIST_HOLE = (7, 5)           # supplier key % 7 = 5: artist page answers null
LI_NULL_TIME = 991             # order key % 991 = 0: played_at missing
LI_BAD_TIME = 997              # order key % 997 = 0: played_at malformed
LI_MS_PER_QTY = 10007          # li duration_ms = quantity * 10007
# linked pages: which are lost, landed twice, landed once more as a last page, or without address; whose last leads to the first
LOST, TWICE, CUT_SHORT, NO_HREF, CIRCLE, LONG_LOST = 41, 43, 53, 59, 47, (997, 5)
PACKED_ROWS = 1_000_000        # rows that one task packs into pages, about
FILE_PAGES = 20_000            # landed pages in a file at most: a compressed file is read by one task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _str(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _dealt(rows: DataFrame, page_key: Column, total: int) -> DataFrame:
    """The table's rows with ``_page``, a page's rows in one task: what is made
    of the columns read, the page too, is made after the shuffle, and a task gets around
    ``PACKED_ROWS`` of the ``total`` rows, which it sorts in memory."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // PACKED_ROWS))
    return rows.repartition(tasks, page_key).withColumn("_page", page_key)


def _pack(items: DataFrame, page_key: Column, item: Column, is_null: Column, array_name: str,
          carry: dict[str, Column] | None = None, *, rows: int) -> DataFrame:
    """Group the ``rows`` items into pages and serialise each page to one JSON line.

    An item flagged by ``is_null`` is written as JSON ``null`` (the API
    answers null for an unknown id). ``carry`` fields are constant per page
    and land as top-level fields of the line (e.g. the playlist id of an
    item page, which the API has in the request, not in the body).
    """
    carry = carry or {}
    w = F.struct(is_null.alias("n"), item.alias("v")).alias("w")
    grouped = (_dealt(items, page_key, rows).select("_page", *[c.alias(n) for n, c in carry.items()], w)
               .groupBy("_page", *carry.keys())
               .agg(F.collect_list("w").alias("ws")))
    body = F.struct(*[F.col(n) for n in carry],
                    F.transform("ws", lambda x: F.when(~x["n"], x["v"])).alias(array_name))
    return grouped.select("_page", F.to_json(body).alias("value"))


def _packer() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of a task's batches: rows that lie together and have one
    ``_page``, as one row with the list ``ws`` of their ``w``. The run that a
    batch ends with is held until it is known whether it goes on. (Made here,
    so that workers need not have this module.)"""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def differs(a, b):
            return pc.fill_null(pc.not_equal(a, b), pc.xor(pc.is_null(a), pc.is_null(b)))

        def pages(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            page = rows.column("_page")
            starts = np.concatenate([[0], np.flatnonzero(differs(page[1:], page[:-1])) + 1])
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(page)), pa.int32()), rows.column("w"))
            return pa.RecordBatch.from_arrays([page.take(pa.array(starts)), lists], names=["_page", "ws"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            page = batch.column("_page")
            changes = np.flatnonzero(differs(page[1:], page[:-1])) + 1
            if len(changes):
                yield pages([*held, batch.slice(0, changes[-1])])
                held = [batch.slice(changes[-1])]
            elif held and not differs(held[-1].column("_page")[-1:], page[:1])[0].as_py():
                held.append(batch)
            else:
                if held:
                    yield pages(held)
                held = [batch]
        if held:
            yield pages(held)

    return runs


def _pack_as_they_lie(items: DataFrame, page_key: Column, item: Column, array_name: str) -> DataFrame:
    """``_pack`` for rows whose pages lie together, without a shuffle."""
    rows = items.select(page_key.alias("_page"), item.alias("w"))
    out = StructType([rows.schema["_page"], StructField("ws", ArrayType(rows.schema["w"].dataType))])
    return rows.mapInArrow(_packer(), out).select("_page", F.to_json(F.struct(F.col("ws").alias(array_name))).alias("value"))


def _single(items: DataFrame, page_key: Column, item: Column, is_null: Column, array_name: str,
            carry: dict[str, Column] | None = None) -> DataFrame:
    """The same items as ``_pack`` but one item per row and no JSON: what a
    stored raw table is made from. Flattening it gives exactly the rows that
    flattening the packed pages gives (tested), without the page shuffle."""
    carry = carry or {}
    return items.select(*[c.alias(n) for n, c in carry.items()],
                        F.array(F.when(~is_null, item)).alias(array_name))


# ----------------------------------------------------------------- plays --
def _ev_k(events: DataFrame) -> Column:
    return F.get_json_object(F.col("props"), "$.k")


def plays_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze_play_history stand-in from ``events`` (one play per event)."""
    ev = table(spark, sf_dir, "events")
    k = _ev_k(ev)
    artist = _str(k.cast("int") % EV_ARTISTS)
    return ev.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("played_at"),
        k.alias("track_id"),
        F.concat(F.lit("Track "), k).alias("track_name"),
        artist.alias("artist_id"),
        F.concat(F.lit("Artist "), artist).alias("artist_name"),
        _str(F.col("user_id") % 50).alias("album_id"),
        F.concat(F.lit("Album "), _str(F.col("user_id") % 50)).alias("album_name"),
        F.col("event_type").alias("context_type"),
        F.round(F.col("value") * 1000).cast("bigint").alias("duration_ms"),
    )


def plays_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze_play_history stand-in from ``lineitem`` (one play per line)."""
    li = table(spark, sf_dir, "lineitem")
    hours = (F.col("l_partkey") + F.dayofmonth("l_shipdate")) % 24
    mins = F.col("l_partkey") % 60
    ts = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), hours.cast("int"), mins.cast("int"))
    played_at = (F.when(F.col("l_orderkey") % LI_NULL_TIME == 0, F.lit(None).cast("string"))
                 .when(F.col("l_orderkey") % LI_BAD_TIME == 0, F.lit("not-a-time"))
                 .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")))
    return li.select(
        played_at.alias("played_at"),
        _str("l_partkey").alias("track_id"),
        F.concat(F.lit("Track "), _str("l_partkey")).alias("track_name"),
        _str("l_suppkey").alias("artist_id"),
        F.concat(F.lit("Artist "), _str("l_suppkey")).alias("artist_name"),
        _str("l_orderkey").alias("album_id"),
        F.concat(F.lit("Album "), _str("l_orderkey")).alias("album_name"),
        F.col("l_returnflag").alias("context_type"),
        (F.col("l_quantity") * LI_MS_PER_QTY).cast("bigint").alias("duration_ms"),
    )


def _play_spec(spark: SparkSession, sf_dir: str) -> tuple:
    """Landed play pages from ``events``: 50 items per page; k = 0 gives a
    null item, k = 1 a null track, k = 2 no artists, k = 3 no context."""
    ev = table(spark, sf_dir, "events")
    k = _ev_k(ev)
    artist = _str(k.cast("int") % EV_ARTISTS)
    artists = F.when(k == "2", F.array().cast("array<struct<id:string,name:string>>")).otherwise(
        F.array(F.struct(artist.alias("id"), F.concat(F.lit("Artist "), artist).alias("name"))))
    track = F.when(k != "1", F.struct(
        k.alias("id"), F.concat(F.lit("Track "), k).alias("name"),
        F.round(F.col("value") * 1000).cast("bigint").alias("duration_ms"),
        artists.alias("artists"),
        F.struct(_str(F.col("user_id") % 50).alias("id"),
                 F.concat(F.lit("Album "), _str(F.col("user_id") % 50)).alias("name")).alias("album"),
    ))
    context = F.when(k != "3", F.struct(F.col("event_type").alias("type")))
    item = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("played_at"),
                    track.alias("track"), context.alias("context"))
    return (ev, F.floor(F.col("event_id") / PAGE_SIZE), item, k == "0", "items")


# ------------------------------------------------------------- catalogue --
def _track_spec(spark: SparkSession, sf_dir: str, holes: bool = True) -> tuple:
    """Landed track catalogue pages from ``part``."""
    p = table(spark, sf_dir, "part")
    key = _str("p_partkey")
    artist = _str(F.col("p_partkey") % 7)
    item = F.struct(
        key.alias("id"), F.col("p_name").alias("name"), F.lit(None).cast("string").alias("preview_url"),
        (F.col("p_size").cast("bigint") * 7919).alias("duration_ms"),
        F.col("p_size").cast("bigint").alias("popularity"),
        (F.col("p_partkey") % 2 == 0).alias("explicit"),
        F.array(F.struct(artist.alias("id"), F.concat(F.lit("Artist "), artist).alias("name"))).alias("artists"),
        F.struct(_str(F.col("p_partkey") % 100).alias("id"), F.col("p_brand").alias("name"),
                 F.concat(_str(F.col("p_partkey") % 30 + 1990), F.lit("-01-01")).alias("release_date")).alias("album"),
    )
    hole = (F.col("p_partkey") % TRACK_HOLE[0] == TRACK_HOLE[1]) if holes else F.lit(False)
    return (p, F.floor(F.col("p_partkey") / PAGE_SIZE), item, hole, "tracks")


def _artist_spec(spark: SparkSession, sf_dir: str, holes: bool = True) -> tuple:
    """Landed artist catalogue pages from ``supplier`` (+ nation, region
    for genres): key % 5 = 1 no genres, = 2 empty genres, = 3 a NULL genre."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    sn = (s.join(n, s.s_nationkey == n.n_nationkey, "left")
          .join(r, n.n_regionkey == r.r_regionkey, "left"))
    m = F.col("s_suppkey") % 5
    genres = (F.when(m == 1, F.lit(None).cast("array<string>"))
              .when(m == 2, F.array().cast("array<string>"))
              .when(m == 3, F.array(F.col("n_name"), F.lit(None).cast("string")))
              .otherwise(F.array(F.col("n_name"), F.col("r_name"))))
    key = _str("s_suppkey")
    item = F.struct(
        key.alias("id"), F.col("s_name").alias("name"), F.concat(F.lit("artist:"), key).alias("uri"),
        genres.alias("genres"),
        F.struct((F.col("s_nationkey").cast("bigint") * 1000 + F.col("s_suppkey")).alias("total")).alias("followers"),
        (F.col("s_suppkey") % 100).cast("bigint").alias("popularity"),
    )
    hole = (F.col("s_suppkey") % ARTIST_HOLE[0] == ARTIST_HOLE[1]) if holes else F.lit(False)
    return (sn, F.floor(F.col("s_suppkey") / PAGE_SIZE), item, hole, "artists")


def _playlist_spec(spark: SparkSession, sf_dir: str) -> tuple:
    """Landed playlist pages from ``orders``: key % 13 = 0 has no id,
    = 1 an empty id; key % 5 = 0 carries a follower total."""
    o = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    ol = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    key = (F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("string"))
           .when(F.col("o_orderkey") % 13 == 1, F.lit(""))
           .otherwise(_str("o_orderkey")))
    item = F.struct(
        key.alias("id"), F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("description"),
        F.concat(F.lit("snap-"), _str("o_custkey")).alias("snapshot_id"),
        F.struct(F.concat(F.lit("Customer "), _str("o_custkey")).alias("display_name")).alias("owner"),
        F.when(F.col("o_orderkey") % 5 == 0, F.struct(F.col("o_custkey").alias("total"))).alias("followers"),
        F.struct(F.coalesce(F.col("n_lines"), F.lit(0)).cast("bigint").alias("total")).alias("tracks"),
    )
    return (ol, F.floor(F.col("o_orderkey") / PAGE_SIZE), item, F.lit(False), "items")


def _playlist_item_spec(spark: SparkSession, sf_dir: str) -> tuple:
    """Landed playlist item pages from ``lineitem`` (one page per order);
    part key % 17 = 0 has no track, % 19 = 0 a track without id; the second
    artist id is missing, empty or present by line number % 3."""
    li = table(spark, sf_dir, "lineitem")
    second = (F.when(F.col("l_linenumber") % 3 == 0, F.lit(None).cast("string"))
              .when(F.col("l_linenumber") % 3 == 1, F.lit(""))
              .otherwise(_str(F.col("l_suppkey") + 1)))
    track = F.when(F.col("l_partkey") % 17 != 0, F.struct(
        F.when(F.col("l_partkey") % 19 != 0, _str("l_partkey")).alias("id"),
        F.concat(F.lit("Track "), _str("l_partkey")).alias("name"),
        (F.col("l_quantity") * LI_MS_PER_QTY).cast("bigint").alias("duration_ms"),
        F.col("l_linenumber").cast("bigint").alias("popularity"),
        F.array(F.struct(_str("l_suppkey").alias("id")), F.struct(second.alias("id"))).alias("artists"),
        F.struct(_str("l_orderkey").alias("id")).alias("album"),
    ))
    item = F.struct(
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("added_at"),
        F.struct(F.concat(F.lit("user"), _str(F.col("l_orderkey") % 10)).alias("id")).alias("added_by"),
        track.alias("track"),
    )
    return (li, F.col("l_orderkey"), item, F.lit(False), "items", {"playlist_id": _str("l_orderkey")})


# ------------------------------------------------ landed pages (JSON) --
def play_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pack(*_play_spec(spark, sf_dir), rows=table(spark, sf_dir, "events").count())


def track_pages(spark: SparkSession, sf_dir: str, holes: bool = True) -> DataFrame:
    return _pack(*_track_spec(spark, sf_dir, holes), rows=table(spark, sf_dir, "part").count())


def artist_pages(spark: SparkSession, sf_dir: str, holes: bool = True) -> DataFrame:
    return _pack(*_artist_spec(spark, sf_dir, holes), rows=table(spark, sf_dir, "supplier").count())


def playlist_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pack(*_playlist_spec(spark, sf_dir), rows=table(spark, sf_dir, "orders").count())


def playlist_item_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pack(*_playlist_item_spec(spark, sf_dir), rows=table(spark, sf_dir, "lineitem").count())


def plays_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_play_history(parse_pages(play_pages(spark, sf_dir), "value", schemas.PLAY_PAGE))


def tracks_from_pages(spark: SparkSession, sf_dir: str, holes: bool = True) -> DataFrame:
    return flatten_tracks(parse_pages(track_pages(spark, sf_dir, holes), "value", schemas.TRACK_PAGE))


def artists_from_pages(spark: SparkSession, sf_dir: str, holes: bool = True) -> DataFrame:
    return flatten_artists(parse_pages(artist_pages(spark, sf_dir, holes), "value", schemas.ARTIST_PAGE))


def playlists_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_playlists(parse_pages(playlist_pages(spark, sf_dir), "value", schemas.PLAYLIST_PAGE))


def playlist_tracks_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_playlist_tracks(parse_pages(playlist_item_pages(spark, sf_dir), "value",
                                               schemas.PLAYLIST_ITEM_PAGE))


# ------------------------------------------- raw tables (stored form) --
def tracks_raw(spark: SparkSession, sf_dir: str, holes: bool = True) -> DataFrame:
    return flatten_tracks(_single(*_track_spec(spark, sf_dir, holes)))


def artists_raw(spark: SparkSession, sf_dir: str, holes: bool = True) -> DataFrame:
    return flatten_artists(_single(*_artist_spec(spark, sf_dir, holes)))


def playlists_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_playlists(_single(*_playlist_spec(spark, sf_dir)))


def playlist_tracks_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_playlist_tracks(_single(*_playlist_item_spec(spark, sf_dir)))


def play_pages_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed play pages holding the ``li`` plays, 50 items per page (page
    number from the row's position in its input partition)."""
    li = plays_li(spark, sf_dir)
    artists = F.array(F.struct(F.col("artist_id").alias("id"), F.col("artist_name").alias("name")))
    item = F.struct(
        F.col("played_at").alias("played_at"),
        F.struct(F.col("track_id").alias("id"), F.col("track_name").alias("name"),
                 F.col("duration_ms").alias("duration_ms"), artists.alias("artists"),
                 F.struct(F.col("album_id").alias("id"), F.col("album_name").alias("name")).alias("album"),
                 ).alias("track"),
        F.struct(F.col("context_type").alias("type")).alias("context"),
    )
    return _pack_as_they_lie(li, F.floor(F.monotonically_increasing_id() / PAGE_SIZE), item, "items")


def grown_track_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, value): track catalogue pages, one item each, of an API that has
    grown: new fields on three levels, and two fields of another type."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    album = F.struct(_str(k % 100).alias("id"), F.col("p_brand").alias("name"), F.when(k % 4 == 0, F.array(F.struct(
        F.col("p_size").alias("height"), F.lit("cover").alias("url")))).alias("images"))
    item = F.struct(
        _str("p_partkey").alias("id"), F.col("p_name").alias("name"), (F.col("p_size").cast("bigint") * 7919).alias("duration_ms"),
        F.when(k % 3 == 0, k % 2 == 0).alias("is_local"), F.when(k % 11 == 0, _str(k)).alias("popularity"),
        F.array(F.struct(_str(k % 7).alias("id"), F.when(k % 5 == 0, F.lit("artist")).alias("type"))).alias("artists"),
        F.when(k % 13 != 0, album).alias("album"), F.when(k % 17 == 0, F.lit(1.5)).alias("explicit"))
    page = F.struct(F.array(F.when(k % TRACK_HOLE[0] != TRACK_HOLE[1], item)).alias("tracks"), F.when(k % 19 == 0, k).alias("total"))
    return p.select(F.lit("bronze_tracks").alias("kind"), F.to_json(page).alias("value"))


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, value): landed pages of listings that lead from one to the next.
    ``playlists``: one listing for each customer, a page for each order;
    ``playlist_tracks``: one long listing, a page for 50 order keys."""
    o = table(spark, sf_dir, "orders")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    address = F.concat(F.lit("playlists/"), _str("o_custkey"), F.lit("?at="), _str("o_orderkey"))
    k = F.col("o_orderkey")
    short = o.select(
        F.lit("playlists").alias("kind"), "o_orderkey", F.when(k % NO_HREF != 0, address).alias("href"),
        F.coalesce(F.lead(address).over(w), F.when(F.col("o_custkey") % CIRCLE == 0, F.first(address).over(w))).alias("next"),
        F.lag(address).over(w).alias("previous"), F.array(F.struct(_str("o_orderkey").alias("id"))).alias("items")).where(k % LOST != 0)
    again = short.where(k % TWICE == 0).unionByName(short.where(k % CUT_SHORT == 0).withColumn("next", F.lit(None).cast("string")))
    short = short.unionByName(again).drop("o_orderkey")
    li = table(spark, sf_dir, "lineitem")
    at = F.floor(F.col("l_orderkey") / PAGE_SIZE)
    last, rows = li.agg(F.max(at), F.count(F.lit(1))).first()
    place, n = (lambda i: F.concat(F.lit("items?page="), _str(i))), F.col("at")
    long = _dealt(li, at, rows).groupBy(F.col("_page").alias("at")).agg(F.collect_list(F.struct(F.struct(_str("l_partkey").alias("id")).alias("track"))).alias("items"))
    long = long.where(n % LONG_LOST[0] != LONG_LOST[1]).select(
        F.lit("playlist_tracks").alias("kind"), place(n).alias("href"), F.when(n < last, place(n + 1)).alias("next"),
        F.when(n > 0, place(n - 1)).alias("previous"), "items")
    body = F.to_json(F.struct("href", "next", "previous", "items")).alias("value")
    return short.select("kind", body).unionByName(long.select("kind", body))


def land_pages(pages: DataFrame, path: str) -> None:
    """Write pages as JSON Lines text: gzip, as pages repeat their field names."""
    pages.select("value").write.mode("overwrite").option("maxRecordsPerFile", FILE_PAGES).text(path, compression="gzip")


def land(spark: SparkSession, sf_dir: str, root: str, plays: str = "li") -> dict[str, str]:
    """Write every kind of landed page under ``root`` as JSON Lines text and
    return the landing map ``pipeline.run`` takes."""
    pages = {
        "plays": play_pages_li(spark, sf_dir) if plays == "li" else play_pages(spark, sf_dir),
        "playlists": playlist_pages(spark, sf_dir),
        "playlist_tracks": playlist_item_pages(spark, sf_dir),
        "tracks": track_pages(spark, sf_dir),
        "artists": artist_pages(spark, sf_dir),
    }
    out = {}
    for kind, df in pages.items():
        path = f"{root}/{kind}"
        land_pages(df, path)
        out[kind] = path
    return out
