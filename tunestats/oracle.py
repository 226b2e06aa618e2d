"""Independent SQL statements of every registered query, for DuckDB.

They run on the driver's parquet tables (views ``events``, ``lineitem``,
``part``, ``supplier``, ``nation``, ``region``, ``orders``) and restate the
fixture rules of ``tunestats.fixtures`` and the builders' semantics in plain
SQL, without JSON pages or Spark. Output conventions shared with the Spark
side (``__spark_entry__._present``): timestamps as
``yyyy-MM-dd HH:mm:ss.ffffff`` text, arrays as JSON text, decimal minutes as
DOUBLE. Minutes are summed exactly: each row is rounded half-up to 7 places
as an integer count of 1e-7 minutes, summed, then scaled once.
"""

from __future__ import annotations

TS = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def ts(c: str) -> str:
    return TS.format(c=c)


def units(c: str) -> str:
    """Per-row minutes ``c / 60000.0`` rounded half-up to 7 places, as an
    integer number of 1e-7 minutes (``c`` >= 0)."""
    return f"(({c}) * 10000000 + 30000) // 60000"


def minutes_of_units(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE) / 10000000"


def minutes_sum(c: str = "duration_ms") -> str:
    return minutes_of_units(f"SUM({units(c)})")


DAY_PART = ("CASE WHEN hour_of_day BETWEEN 6 AND 11 THEN 'Morning' "
            "WHEN hour_of_day BETWEEN 12 AND 17 THEN 'Afternoon' "
            "WHEN hour_of_day BETWEEN 18 AND 23 THEN 'Evening' ELSE 'Night' END")

# ------------------------------------------------------------ stand-ins --
PLAYS_EV = """plays_ev AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS played_at,
         k AS track_id, 'Track ' || k AS track_name,
         CAST(CAST(k AS INTEGER) % 20 AS VARCHAR) AS artist_id,
         'Artist ' || CAST(CAST(k AS INTEGER) % 20 AS VARCHAR) AS artist_name,
         CAST(user_id % 50 AS VARCHAR) AS album_id, 'Album ' || CAST(user_id % 50 AS VARCHAR) AS album_name,
         event_type AS context_type, CAST(round(value * 1000) AS BIGINT) AS duration_ms
  FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events))"""

PLAYS_LI = """plays_li AS (
  SELECT CASE WHEN l_orderkey % 991 = 0 THEN NULL
              WHEN l_orderkey % 997 = 0 THEN 'not-a-time'
              ELSE strftime(l_shipdate + to_hours(CAST((l_partkey + dayofmonth(l_shipdate)) % 24 AS BIGINT))
                                       + to_minutes(CAST(l_partkey % 60 AS BIGINT)), '%Y-%m-%dT%H:%M:%S.%gZ')
         END AS played_at,
         CAST(l_partkey AS VARCHAR) AS track_id, 'Track ' || CAST(l_partkey AS VARCHAR) AS track_name,
         CAST(l_suppkey AS VARCHAR) AS artist_id, 'Artist ' || CAST(l_suppkey AS VARCHAR) AS artist_name,
         CAST(l_orderkey AS VARCHAR) AS album_id, 'Album ' || CAST(l_orderkey AS VARCHAR) AS album_name,
         l_returnflag AS context_type, CAST(l_quantity * 10007 AS BIGINT) AS duration_ms
  FROM lineitem)"""


def tracks_raw(holes: bool = True, name: str = "tracks_raw") -> str:
    # fixture rule: the track catalogue answers null for these ids (no row)
    where = "WHERE p_partkey % 10 <> 3  -- catalogue hole, see fixtures.TRACK_HOLE" if holes else ""
    return f"""{name} AS (
  SELECT CAST(p_partkey AS VARCHAR) AS track_id, p_name AS track_name,
         CAST(p_partkey % 100 AS VARCHAR) AS album_id, p_brand AS album_name,
         CAST(p_partkey % 7 AS VARCHAR) AS artist_id, 'Artist ' || CAST(p_partkey % 7 AS VARCHAR) AS artist_name,
         CAST(p_size AS BIGINT) * 7919 AS duration_ms, CAST(p_size AS BIGINT) AS popularity,
         p_partkey % 2 = 0 AS explicit, CAST(p_partkey % 30 + 1990 AS VARCHAR) || '-01-01' AS release_date,
         CAST(NULL AS VARCHAR) AS preview_url
  FROM part {where}
)"""


def artists_raw(holes: bool = True, name: str = "artists_raw") -> str:
    # fixture rule: the artist catalogue answers null for these ids (no row)
    where = "WHERE s_suppkey % 7 <> 5  -- catalogue hole, see fixtures.ARTIST_HOLE" if holes else ""
    return f"""{name} AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS artist_id, s_name AS artist_name,
         CASE s_suppkey % 5 WHEN 1 THEN NULL WHEN 2 THEN []::VARCHAR[]
              WHEN 3 THEN [n_name, NULL]::VARCHAR[] ELSE [n_name, r_name]::VARCHAR[] END AS genres,
         CAST(s_nationkey AS BIGINT) * 1000 + s_suppkey AS followers,
         CAST(s_suppkey % 100 AS BIGINT) AS popularity, 'artist:' || CAST(s_suppkey AS VARCHAR) AS uri
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
  {where}
)"""


PLAYLISTS_RAW = """playlists_raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS playlist_id, o_orderpriority AS playlist_name,
         'Customer ' || CAST(o_custkey AS VARCHAR) AS owner_name,
         CASE WHEN o_orderkey % 5 = 0 THEN o_custkey END AS followers,
         CAST(COALESCE(n_lines, 0) AS BIGINT) AS total_tracks, o_orderstatus AS description,
         'snap-' || CAST(o_custkey AS VARCHAR) AS snapshot_id
  FROM orders LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n_lines FROM lineitem GROUP BY l_orderkey) c
       ON o_orderkey = c.l_orderkey
  WHERE o_orderkey % 13 NOT IN (0, 1)  -- playlists landed without id / with an empty id are dropped
)"""

ITEMS_RAW = """items_raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS playlist_id, CAST(l_partkey AS VARCHAR) AS track_id,
         'Track ' || CAST(l_partkey AS VARCHAR) AS track_name,
         CASE WHEN l_linenumber % 3 = 2 THEN [CAST(l_suppkey AS VARCHAR), CAST(l_suppkey + 1 AS VARCHAR)]
              ELSE [CAST(l_suppkey AS VARCHAR)] END AS artist_ids,
         CAST(l_orderkey AS VARCHAR) AS album_id, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS added_at,
         'user' || CAST(l_orderkey % 10 AS VARCHAR) AS added_by,
         CAST(l_quantity * 10007 AS BIGINT) AS duration_ms, CAST(l_linenumber AS BIGINT) AS popularity
  FROM lineitem
  WHERE l_partkey % 17 <> 0 AND l_partkey % 19 <> 0  -- items landed without track / track id are dropped
)"""


def fct(src: str, name: str) -> str:
    """TBL-5 over a plays CTE: key, parse, keep the smallest row per key."""
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in
                      ["play_timestamp", "track_id", "artist_id", "album_id", "duration_ms", "context_type"])
    return f"""{name} AS (
  SELECT play_id, play_timestamp, track_id, artist_id, album_id, duration_ms, context_type FROM (
    SELECT *, row_number() OVER (PARTITION BY play_id ORDER BY {order}) AS rn FROM (
      SELECT sha256(played_at || track_id) AS play_id, TRY_CAST(played_at AS TIMESTAMP) AS play_timestamp,
             track_id, artist_id, album_id, duration_ms, context_type FROM {src}))
  WHERE rn = 1)"""


def base(fct_name: str = "fct_li", tracks: str = "tracks_raw", artists: str = "artists_raw",
         name: str = "base") -> str:
    return f"""{name} AS (
  SELECT f.play_id, f.play_timestamp, f.duration_ms, f.context_type,
         t.track_id, t.track_name, t.popularity, a.artist_id, a.artist_name, a.genres,
         CAST(hour(f.play_timestamp) AS INTEGER) AS hour_of_day,
         strftime(f.play_timestamp, '%a') AS weekday_name, strftime(f.play_timestamp, '%Y-%m') AS month
  FROM {fct_name} f LEFT JOIN {tracks} t ON f.track_id = t.track_id
                    LEFT JOIN {artists} a ON f.artist_id = a.artist_id)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE_CTES = (PLAYS_LI, tracks_raw(), artists_raw(), fct("plays_li", "fct_li"), base())

SUMMARY = """artist_rank AS (
  SELECT artist_name, row_number() OVER (ORDER BY n DESC, artist_name ASC NULLS LAST) AS place
  FROM (SELECT artist_name, COUNT(*) AS n FROM {b} GROUP BY ALL)),
track_rank AS (
  SELECT track_name, row_number() OVER (ORDER BY n DESC, track_name ASC NULLS LAST) AS place
  FROM (SELECT track_name, COUNT(*) AS n FROM {b} GROUP BY ALL)),
summary AS (
  SELECT 'default_user' AS user_id, COUNT(play_id) AS total_tracks, COUNT(DISTINCT artist_id) AS unique_artists,
         SUM({u}) AS total_units, (SELECT artist_name FROM artist_rank WHERE place = 1) AS favorite_artist,
         (SELECT track_name FROM track_rank WHERE place = 1) AS top_track
  FROM {b} HAVING COUNT(*) > 0)"""


def summary(b: str = "base") -> str:
    return SUMMARY.format(u=units("duration_ms"), b=b)


SUMMARY_SELECT = (f"SELECT user_id, total_tracks, unique_artists, {minutes_of_units('total_units')} AS total_minutes, "
                  "favorite_artist, top_track FROM summary")

TOP_TRACKS = f"""top_tracks AS (
  SELECT track_id, track_name, artist_name, COUNT(play_id) AS play_count,
         SUM({units('duration_ms')}) AS total_units, MAX(popularity) AS popularity
  FROM base WHERE track_id IS NOT NULL GROUP BY track_id, track_name, artist_name)"""

TOP_ARTISTS = f"""top_artists AS (
  SELECT artist_id, artist_name, COUNT(play_id) AS total_plays, COUNT(DISTINCT track_id) AS unique_tracks,
         SUM({units('duration_ms')}) AS total_units, CAST(to_json(ANY_VALUE(genres)) AS VARCHAR) AS genres
  FROM base WHERE artist_id IS NOT NULL GROUP BY artist_id, artist_name)"""

GENRE_TRENDS = """genre_trends AS (
  SELECT genre, month, COUNT(play_id) AS total_plays, AVG(popularity) AS avg_popularity,
         COUNT(DISTINCT 'default_user') AS unique_users
  FROM (SELECT play_id, popularity, month, UNNEST(genres) AS genre FROM base)
  WHERE genre IS NOT NULL GROUP BY genre, month)"""

PATTERNS = f"""patterns AS (
  SELECT 'default_user' AS user_id, hour_of_day, weekday_name, SUM({units('duration_ms')}) AS total_units
  FROM base GROUP BY hour_of_day, weekday_name)"""

REPORT_TOP_ARTISTS = f"""rpt_artists AS (
  SELECT artist_name, total_units, total_plays, unique_tracks FROM top_artists
  ORDER BY total_units DESC, artist_name ASC NULLS LAST, total_plays DESC, unique_tracks DESC LIMIT 100)"""

REPORT_TOP_TRACKS = """rpt_tracks AS (
  SELECT track_name, artist_name, play_count, popularity FROM top_tracks
  ORDER BY play_count DESC, track_name ASC NULLS LAST, artist_name ASC NULLS LAST, popularity DESC NULLS LAST
  LIMIT 100)"""

DAY_PARTS = f"""day_parts AS (
  SELECT weekday_name, {DAY_PART} AS time_period, SUM(total_units) AS total_units
  FROM patterns GROUP BY weekday_name, time_period)"""


def relanded(raw: str, key: str, name: str) -> str:
    """Re-landed rows and the survivor of each key: the smallest row, NULL first."""
    return f"""landed AS (
  SELECT * FROM {raw} UNION ALL BY NAME
  SELECT * REPLACE (CASE right({key}, 1) WHEN '1' THEN '!' || {name} WHEN '4' THEN {name} || '~' END AS {name})
  FROM {raw} WHERE right({key}, 1) IN ('1', '4', '7')),
survivors AS (
  SELECT * EXCLUDE (_place) FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {name} ASC NULLS FIRST) AS _place FROM landed)
  WHERE _place = 1)"""


#: fixtures.linked_pages as (kind, page, next, previous), and every chain walked from each of its pages.
PAGE_CHAINS = """RECURSIVE at_customer AS (
  SELECT o_orderkey AS k, o_custkey AS c, 'playlists/' || o_custkey || '?at=' || o_orderkey AS address FROM orders),
short AS (
  SELECT k, 'playlists' AS kind, CASE WHEN k % 59 <> 0 THEN address END AS page,
         coalesce(lead(address) OVER w, CASE WHEN c % 47 = 0 THEN first_value(address) OVER w END) AS next, lag(address) OVER w AS previous
  FROM at_customer WINDOW w AS (PARTITION BY c ORDER BY k)),
long AS (SELECT DISTINCT l_orderkey // 50 AS i FROM lineitem),
landed AS (
  SELECT kind, page, next, previous FROM short WHERE k % 41 <> 0
  UNION ALL SELECT kind, page, next, previous FROM short WHERE k % 41 <> 0 AND k % 43 = 0
  UNION ALL SELECT kind, page, NULL, previous FROM short WHERE k % 41 <> 0 AND k % 53 = 0
  UNION ALL SELECT 'playlist_tracks', 'items?page=' || i, CASE WHEN i < (SELECT MAX(i) FROM long) THEN 'items?page=' || (i + 1) END,
                   CASE WHEN i > 0 THEN 'items?page=' || (i - 1) END FROM long WHERE i % 997 <> 5),
nodes AS (
  SELECT kind, page, COUNT(*) AS copies, MIN(next) AS next, COUNT(DISTINCT coalesce(next, '')) > 1 AS conflict, bool_or(previous IS NULL) AS first
  FROM landed WHERE page IS NOT NULL GROUP BY kind, page),
known AS (
  SELECT n.*, t.page IS NOT NULL AS landed, (SELECT COUNT(*) FROM nodes l WHERE l.kind = n.kind AND l.next = n.page) AS leaders
  FROM nodes n LEFT JOIN nodes t ON t.kind = n.kind AND t.page = n.next),
reach AS (
  SELECT kind, page AS start, page AS at FROM known
  UNION SELECT r.kind, r.start, k.next FROM reach r JOIN known k ON k.kind = r.kind AND k.page = r.at AND k.landed),
circles AS (SELECT k.kind, k.page FROM known k JOIN reach r ON r.kind = k.kind AND r.start = k.next AND r.at = k.page),
placed AS (
  SELECT r.kind, r.start AS page, coalesce(MIN(CASE WHEN NOT k.landed THEN r.at END), MIN(c.page)) AS chain, bool_and(k.landed) AS cyclic
  FROM reach r JOIN known k ON k.kind = r.kind AND k.page = r.at LEFT JOIN circles c ON c.kind = r.kind AND c.page = r.at
  GROUP BY r.kind, r.start),
sums AS (
  SELECT kind, chain, bool_or(cyclic) AS cyclic, COUNT(*) AS n_pages, CAST(SUM(copies - 1) AS BIGINT) AS n_repeats,
         COUNT(*) FILTER (leaders = 0) AS n_heads, COUNT(*) FILTER (leaders = 0 AND NOT first) AS n_headless,
         COUNT(*) FILTER (conflict) AS n_conflicts, bool_or(leaders > 1) AS merged, MAX(CASE WHEN NOT landed THEN next END) AS missing
  FROM placed JOIN known USING (kind, page) GROUP BY kind, chain)
SELECT kind, chain, CASE WHEN cyclic THEN 'cycle' WHEN missing IS NOT NULL THEN 'missing' WHEN n_headless > 0 THEN 'headless'
                         WHEN n_conflicts > 0 THEN 'conflict' WHEN merged THEN 'merged' WHEN n_repeats > 0 THEN 'repeated' ELSE 'complete' END AS status,
       n_pages, n_repeats, n_heads, n_headless, n_conflicts, missing FROM sums
UNION ALL SELECT kind, NULL, 'unaddressed', COUNT(*), 0, 0, 0, 0, NULL FROM landed WHERE page IS NULL GROUP BY kind"""


def requests(keys: str, catalogue: str, key: str) -> str:
    """Ids of a CTE without a catalogue row, fifty to a request."""
    return f"""SELECT request, COUNT(*) AS n_ids, string_agg({key}, ',' ORDER BY {key}) AS ids FROM (
  SELECT {key}, (row_number() OVER (ORDER BY {key}) - 1) // 50 AS request FROM {keys}
  WHERE {key} NOT IN (SELECT {key} FROM {catalogue})) GROUP BY request"""


def statements() -> dict[str, str]:
    B = with_(*BASE_CTES)
    q: dict[str, str] = {}

    # ---- sources ----------------------------------------------------
    q["flatten_play_pages"] = """
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS played_at,
       CASE WHEN k = '1' THEN NULL ELSE k END AS track_id,
       CASE WHEN k = '1' THEN NULL ELSE 'Track ' || k END AS track_name,
       CASE WHEN k IN ('1', '2') THEN NULL ELSE CAST(CAST(k AS INTEGER) % 20 AS VARCHAR) END AS artist_id,
       CASE WHEN k IN ('1', '2') THEN NULL ELSE 'Artist ' || CAST(CAST(k AS INTEGER) % 20 AS VARCHAR) END AS artist_name,
       CASE WHEN k = '1' THEN NULL ELSE CAST(user_id % 50 AS VARCHAR) END AS album_id,
       CASE WHEN k = '1' THEN NULL ELSE 'Album ' || CAST(user_id % 50 AS VARCHAR) END AS album_name,
       CASE WHEN k = '3' THEN NULL ELSE event_type END AS context_type,
       CASE WHEN k = '1' THEN NULL ELSE CAST(round(value * 1000) AS BIGINT) END AS duration_ms
FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)
WHERE k <> '0'  -- fixture rule: these page items are landed as null and dropped
"""
    q["flatten_playlist_pages"] = with_(PLAYLISTS_RAW) + "SELECT * FROM playlists_raw"
    q["flatten_playlist_item_pages"] = with_(ITEMS_RAW) + (
        "SELECT playlist_id, track_id, track_name, CAST(to_json(artist_ids) AS VARCHAR) AS artist_ids, album_id, added_at, "
        "added_by, duration_ms, popularity FROM items_raw")
    q["flatten_track_pages"] = with_(tracks_raw()) + "SELECT * FROM tracks_raw"
    q["flatten_artist_pages"] = with_(artists_raw()) + (
        "SELECT artist_id, artist_name, CAST(to_json(genres) AS VARCHAR) AS genres, followers, popularity, uri FROM artists_raw")
    q["recent_plays"] = with_(PLAYS_EV) + (
        "SELECT * FROM plays_ev WHERE TRY_CAST(played_at AS TIMESTAMP) > "
        "TIMESTAMP '2024-01-16 00:00:00' - INTERVAL 24 HOURS")
    harvest = with_(PLAYS_EV, ITEMS_RAW,
                    """track_keys AS (SELECT DISTINCT track_id FROM (
      SELECT track_id FROM plays_ev UNION ALL SELECT track_id FROM items_raw)
    WHERE track_id IS NOT NULL AND length(track_id) > 0)""",
                    """artist_keys AS (SELECT DISTINCT artist_id FROM (
      SELECT artist_id FROM plays_ev UNION ALL SELECT UNNEST(artist_ids) AS artist_id FROM items_raw)
    WHERE artist_id IS NOT NULL AND length(artist_id) > 0)""",
                    tracks_raw(), artists_raw())
    q["harvest_track_keys"] = harvest + "SELECT track_id FROM track_keys"
    q["harvest_artist_keys"] = harvest + "SELECT artist_id FROM artist_keys"
    q["enrich_tracks"] = harvest + "SELECT * FROM tracks_raw WHERE track_id IN (SELECT track_id FROM track_keys)"
    q["enrich_artists"] = harvest + (
        "SELECT artist_id, artist_name, CAST(to_json(genres) AS VARCHAR) AS genres, followers, popularity, uri "
        "FROM artists_raw WHERE artist_id IN (SELECT artist_id FROM artist_keys)")

    q["page_chains"] = "WITH " + PAGE_CHAINS
    q["missing_track_requests"] = harvest + requests("track_keys", "tracks_raw", "track_id")
    q["missing_artist_requests"] = harvest + requests("artist_keys", "artists_raw", "artist_id")

    q["unknown_page_fields"] = """
SELECT 'bronze_tracks' AS kind, path, problem, COUNT(*) AS n, string_agg(DISTINCT type, ',' ORDER BY type) AS types FROM (
  SELECT unnest([
    CASE WHEN k % 19 = 0 THEN {'path': 'total', 'problem': 'unknown', 'type': 'BIGINT'} END,
    CASE WHEN k % 10 <> 3 AND k % 3 = 0 THEN {'path': 'tracks[].is_local', 'problem': 'unknown', 'type': 'BOOLEAN'} END,
    CASE WHEN k % 10 <> 3 AND k % 11 = 0 THEN {'path': 'tracks[].popularity', 'problem': 'type', 'type': 'STRING'} END,
    CASE WHEN k % 10 <> 3 AND k % 5 = 0 THEN {'path': 'tracks[].artists[].type', 'problem': 'unknown', 'type': 'STRING'} END,
    CASE WHEN k % 10 <> 3 AND k % 13 <> 0 AND k % 4 = 0 THEN
      {'path': 'tracks[].album.images', 'problem': 'unknown', 'type': 'ARRAY<OBJECT<height: BIGINT, url: STRING>>'} END,
    CASE WHEN k % 10 <> 3 AND k % 17 = 0 THEN {'path': 'tracks[].explicit', 'problem': 'type', 'type': 'DECIMAL(2,1)'} END], recursive := true)
  FROM (SELECT p_partkey AS k FROM part)) WHERE path IS NOT NULL GROUP BY path, problem"""

    # ---- model ------------------------------------------------------
    q["dim_time"] = with_(PLAYS_LI) + f"""
SELECT {ts('play_timestamp')} AS play_timestamp, CAST(hour(play_timestamp) AS INTEGER) AS hour_of_day,
       CAST(dayofweek(play_timestamp) + 1 AS INTEGER) AS day_of_week_num,
       strftime(play_timestamp, '%a') AS weekday_name, strftime(play_timestamp, '%b') AS month_name,
       CAST(quarter(play_timestamp) AS INTEGER) AS quarter, CAST(year(play_timestamp) AS INTEGER) AS year
FROM (SELECT DISTINCT TRY_CAST(played_at AS TIMESTAMP) AS play_timestamp FROM plays_li)"""
    q["dim_tracks"] = with_(tracks_raw(), relanded("tracks_raw", "track_id", "track_name")) + (
        "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS preview_url) FROM survivors")
    q["dim_artists"] = with_(artists_raw(), relanded("artists_raw", "artist_id", "artist_name")) + (
        "SELECT artist_id, artist_name, CAST(to_json(genres) AS VARCHAR) AS genres, followers, popularity, uri FROM survivors")
    q["dim_playlists"] = with_(PLAYLISTS_RAW, relanded("playlists_raw", "playlist_id", "playlist_name")) + (
        "SELECT * REPLACE (CAST(NULL AS BIGINT) AS followers) FROM survivors")
    fct_cols = (f"SELECT play_id, {ts('play_timestamp')} AS play_timestamp, track_id, artist_id, album_id, "
                "duration_ms, context_type FROM ")
    q["fct_plays_ev"] = with_(PLAYS_EV, fct("plays_ev", "fct_ev")) + fct_cols + "fct_ev"
    q["fct_plays_li"] = with_(PLAYS_LI, fct("plays_li", "fct_li")) + fct_cols + "fct_li"
    q["fct_plays_repeats"] = q["fct_plays_li"]

    # ---- marts ------------------------------------------------------
    q["base_analytics"] = B + f"""
SELECT play_id, {ts('play_timestamp')} AS play_timestamp, duration_ms, context_type, track_id, track_name,
       popularity, artist_id, artist_name, CAST(to_json(genres) AS VARCHAR) AS genres, hour_of_day, weekday_name, month
FROM base"""
    q["user_summary"] = with_(*BASE_CTES, summary()) + SUMMARY_SELECT
    q["user_summary_full_dims"] = with_(
        PLAYS_LI, tracks_raw(False), artists_raw(False), fct("plays_li", "fct_li"), base(), summary()
    ) + SUMMARY_SELECT
    q["top_tracks"] = with_(*BASE_CTES, TOP_TRACKS) + (
        f"SELECT track_id, track_name, artist_name, play_count, {minutes_of_units('total_units')} AS total_minutes, "
        "popularity FROM top_tracks")
    q["top_artists"] = with_(*BASE_CTES, TOP_ARTISTS) + (
        f"SELECT artist_id, artist_name, total_plays, unique_tracks, {minutes_of_units('total_units')} "
        "AS total_minutes, genres FROM top_artists")
    q["genre_trends"] = with_(*BASE_CTES, GENRE_TRENDS) + "SELECT * FROM genre_trends"
    q["listening_patterns"] = with_(*BASE_CTES, PATTERNS) + (
        f"SELECT user_id, hour_of_day, weekday_name, {minutes_of_units('total_units')} AS total_minutes "
        "FROM patterns")

    # ---- reports ----------------------------------------------------
    q["report_genre_trends"] = with_(*BASE_CTES, GENRE_TRENDS) + (
        "SELECT month, genre, total_plays, avg_popularity FROM genre_trends")
    q["report_top_artists"] = with_(*BASE_CTES, TOP_ARTISTS, REPORT_TOP_ARTISTS) + (
        f"SELECT artist_name, {minutes_of_units('total_units')} AS total_minutes, total_plays, unique_tracks "
        "FROM rpt_artists")
    q["report_top_tracks"] = with_(*BASE_CTES, TOP_TRACKS, REPORT_TOP_TRACKS) + "SELECT * FROM rpt_tracks"
    q["report_day_parts"] = with_(*BASE_CTES, PATTERNS, DAY_PARTS) + (
        f"SELECT weekday_name, time_period, {minutes_of_units('total_units')} AS total_minutes FROM day_parts")
    q["report_kpis"] = with_(*BASE_CTES, summary()) + (
        f"SELECT total_tracks, unique_artists, {minutes_of_units('total_units')} AS total_minutes, "
        "favorite_artist, top_track FROM summary")
    q["report_top_genres"] = with_(*BASE_CTES, GENRE_TRENDS) + """
SELECT genre, CAST(SUM(total_plays) AS BIGINT) AS total_plays FROM genre_trends GROUP BY genre
ORDER BY total_plays DESC, genre ASC NULLS LAST LIMIT 10"""

    # ---- tiles ------------------------------------------------------
    q["tile_genre_plays"] = with_(*BASE_CTES, GENRE_TRENDS) + "SELECT genre, month, total_plays FROM genre_trends"
    q["tile_artist_minutes"] = with_(*BASE_CTES, TOP_ARTISTS, REPORT_TOP_ARTISTS) + (
        f"SELECT {minutes_of_units('total_units')} AS total_minutes, artist_name FROM rpt_artists")
    q["tile_track_plays"] = with_(*BASE_CTES, TOP_TRACKS, REPORT_TOP_TRACKS) + (
        "SELECT track_name, play_count FROM rpt_tracks")
    q["tile_heatmap"] = with_(*BASE_CTES, PATTERNS, DAY_PARTS) + (
        f"SELECT weekday_name, time_period, {minutes_of_units('SUM(total_units)')} AS sum_total_minutes "
        "FROM day_parts GROUP BY weekday_name, time_period")
    q["tile_favourites"] = with_(*BASE_CTES, summary()) + "SELECT top_track, favorite_artist FROM summary"
    q["tile_total_tracks"] = with_(*BASE_CTES, summary()) + (
        "SELECT CAST(SUM(total_tracks) AS BIGINT) AS sum_total_tracks FROM summary")
    q["tile_total_minutes"] = with_(*BASE_CTES, summary()) + (
        f"SELECT {minutes_of_units('SUM(total_units)')} AS sum_total_minutes FROM summary")

    # ---- sinks (content read back) ----------------------------------
    q["write_read_roundtrip"] = q["fct_plays_li"]
    q["write_with_schema_roundtrip"] = with_(tracks_raw()) + "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS preview_url) FROM tracks_raw"
    q["overwrite_roundtrip"] = with_(PLAYLISTS_RAW) + "SELECT playlist_id, total_tracks FROM playlists_raw"

    q["skip_empty_roundtrip"] = q["flatten_playlist_pages"]
    q["artist_unique_tracks"] = B + """
SELECT artist_id, CASE WHEN GROUPING(month) = 0 THEN 'month' ELSE 'all' END AS span, month, COUNT(DISTINCT track_id) AS unique_tracks
FROM base WHERE artist_id IS NOT NULL AND track_id IS NOT NULL GROUP BY GROUPING SETS ((artist_id, month), (artist_id))"""

    # ---- the layers' stored tables, and orders ------------------------
    q["pipeline_bronze_plays"] = with_(PLAYS_LI) + "SELECT * FROM plays_li"
    q["pipeline_bronze_playlists"] = q["flatten_playlist_pages"]
    q["pipeline_fct_plays"] = q["fct_plays_li"]
    for name, same in (("base", "base_analytics"), ("summary", "user_summary"), ("top_tracks", "top_tracks"),
                       ("top_artists", "top_artists"), ("genre_trends", "genre_trends"), ("listening_patterns", "listening_patterns")):
        q[f"pipeline_{name}"] = q[same]
    q["live_fct_plays"] = q["fct_plays_li"]
    q["live_genre_trends"], q["live_listening_patterns"] = q["genre_trends"], q["listening_patterns"]
    q["base_analytics_time_join"] = q["base_analytics"]
    place = "CAST(row_number() OVER (ORDER BY {}) AS INTEGER) AS position"
    q["top_tracks_ordered"] = "SELECT *, " + place.format(
        "play_count DESC, track_name ASC NULLS LAST, artist_name ASC NULLS LAST, popularity DESC NULLS LAST") + (
        f" FROM ({q['report_top_tracks']})")
    q["genre_trends_ordered"] = "SELECT *, " + place.format("month ASC NULLS FIRST, total_plays DESC, genre ASC") + f" FROM ({q['genre_trends']})"
    q["listening_patterns_ordered"] = "SELECT *, " + place.format("hour_of_day ASC NULLS FIRST, weekday_name ASC NULLS FIRST") + (
        f" FROM ({q['listening_patterns']})")
    q["top_artists_ordered"] = "SELECT *, " + place.format("total_plays DESC, artist_id") + f" FROM ({q['top_artists']})"
    q["tile_artist_minutes_ordered"] = "SELECT *, " + place.format("total_minutes DESC, artist_name ASC NULLS LAST") + (
        f" FROM ({q['tile_artist_minutes']})")
    q["report_top_artists_ordered"] = "SELECT *, " + place.format(
        "total_minutes DESC, artist_name ASC NULLS LAST, total_plays DESC, unique_tracks DESC") + f" FROM ({q['report_top_artists']})"
    q["report_day_parts_ordered"] = "SELECT *, " + place.format("weekday_name ASC NULLS FIRST, time_period ASC NULLS FIRST") + (
        f" FROM ({q['report_day_parts']})")
    q["report_top_genres_ordered"] = "SELECT *, " + place.format("total_plays DESC, genre ASC NULLS LAST") + f" FROM ({q['report_top_genres']})"
    q["stored_top_tracks_order"] = "SELECT *, " + place.format(
        "play_count DESC, track_id, track_name ASC NULLS FIRST, artist_name ASC NULLS FIRST") + f" FROM ({q['top_tracks']})"
    q["stored_top_artists_order"] = q["top_artists_ordered"]
    q["stored_genre_trends_order"] = q["genre_trends_ordered"]
    return q
