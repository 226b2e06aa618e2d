"""End to end on landed pages derived from sf0.001, with the invariants of
the survey's test plan (row preservation, unique dims, minute totals,
explode counts, rerun determinism, equality with the per-query path)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tunestats import fixtures as fx
from tunestats.plans import marts, pipeline
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def run(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="tunestats-pipe-")
    landing = fx.land(spark, SF_SMALL, f"{root}/landing")
    written = pipeline.run(spark, landing, database="tp", root=f"{root}/tables")
    written2 = pipeline.run(spark, landing, database="tp2", root=f"{root}/tables2")
    return written, written2


def _t(spark, name, db="tp"):
    layer = "bronze" if name.startswith("bronze") else "silver" if name.startswith(("dim", "fct")) else "gold"
    return spark.table(f"{db}_{layer}.{name}")


def test_counts_and_row_preservation(spark, run):
    written, _ = run
    assert written["bronze"]["bronze_play_history"] == 6000
    assert written["base"]["base_analytics"] == written["silver"]["fct_plays"]
    assert written["gold"]["gold_user_listening_summary"] == 1


def test_dims_unique(spark, run):
    for name, key in [("dim_tracks", "track_id"), ("dim_artists", "artist_id"), ("dim_playlists", "playlist_id"),
                      ("fct_plays", "play_id"), ("dim_time", "play_timestamp")]:
        t = _t(spark, name)
        assert t.count() == t.select(key).distinct().count(), name


def test_minute_totals_agree(spark, run):
    summary = _t(spark, "gold_user_listening_summary").first().total_minutes
    patterns = _t(spark, "gold_listening_patterns").agg(F.sum("total_minutes")).first()[0]
    from tunestats.plans import reports
    parts = reports.report_day_parts(_t(spark, "gold_listening_patterns")).agg(F.sum("total_minutes")).first()[0]
    assert summary == patterns == parts


def test_genre_explode_count(spark, run):
    base = _t(spark, "base_analytics")
    expected = (base.where("play_id IS NOT NULL")
                .select(F.size(F.filter(F.coalesce("genres", F.array().cast("array<string>")),
                                        lambda g: g.isNotNull())).alias("n"))
                .agg(F.sum("n")).first()[0])
    assert _t(spark, "gold_genre_trends").agg(F.sum("total_plays")).first()[0] == expected


def test_rerun_is_deterministic(spark, run):
    for name in pipeline.SILVER + pipeline.GOLD + ("base_analytics",):
        a, b = _t(spark, name, "tp"), _t(spark, name, "tp2")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_gold_equals_query_path(spark, run):
    base = E._lazy_base(spark, SF_SMALL)
    for name, build in [("gold_top_tracks", marts.top_tracks), ("gold_top_artists", marts.top_artists),
                        ("gold_genre_trends", marts.genre_trends), ("gold_listening_patterns", marts.listening_patterns),
                        ("gold_user_listening_summary", marts.user_summary)]:
        a, b = _t(spark, name), build(base)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_report_sql_over_stored_tables(spark, run):
    from tunestats.plans import report_sql, reports
    g = lambda n: _t(spark, n)
    frames = {
        "report_genre_trends": reports.report_genre_trends(g("gold_genre_trends")),
        "report_top_artists": reports.report_top_artists(g("gold_top_artists")),
        "report_top_tracks": reports.report_top_tracks(g("gold_top_tracks")),
        "report_day_parts": reports.report_day_parts(g("gold_listening_patterns")),
        "report_kpis": reports.report_kpis(g("gold_user_listening_summary")),
        "report_top_genres": reports.report_top_genres(g("gold_genre_trends")),
    }
    for name, df in frames.items():
        sql = report_sql.run_report(spark, name, "tp_gold")
        assert sql.columns == df.columns, name
        assert [tuple(r) for r in sql.collect()] == [tuple(r) for r in df.collect()], name


def test_layers_as_separate_jobs_via_cli(spark, run):
    """The command line runs the layers one by one on the session; the
    result equals the single-call run."""
    import tempfile
    from tunestats.__main__ import main
    root = tempfile.mkdtemp(prefix="tunestats-cli-")
    landing = fx.land(spark, SF_SMALL, f"{root}/landing")
    base = landing["plays"].rsplit("/", 1)[0]
    out = main(["--landing", base, "--root", f"{root}/tables", "--database", "tc", "--layers", "bronze"])
    assert out["bronze"]["bronze_play_history"] == 6000
    out = main(["--root", f"{root}/tables", "--database", "tc", "--layers", "silver,gold"])
    assert out["gold"]["gold_user_listening_summary"] == 1
    a, b = _t(spark, "gold_top_artists", "tc"), _t(spark, "gold_top_artists", "tp")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_run_with_ingestion_window(spark):
    """With run_ts only the last 24 hours of plays land in the raw table,
    and the catalogue is restricted to the ids those plays and the playlist
    items use."""
    import tempfile
    from tunestats.sources import recent
    root = tempfile.mkdtemp(prefix="tunestats-window-")
    landing = fx.land(spark, SF_SMALL, f"{root}/landing", plays="ev")
    run_ts = "2024-01-16T00:00:00Z"
    written = pipeline.run_bronze(spark, landing, database="tw", root=f"{root}/t", run_ts=run_ts)
    want = recent(fx.plays_from_pages(spark, SF_SMALL), run_ts, 24)
    got = spark.table("tw_bronze.bronze_play_history")
    assert written["bronze_play_history"] == want.count() == got.count() > 0
    assert got.exceptAll(want).count() == 0
    keys = (got.select("track_id").union(spark.table("tw_bronze.bronze_playlist_tracks").select("track_id"))
            .distinct())
    assert spark.table("tw_bronze.bronze_tracks").join(keys, "track_id", "left_anti").count() == 0


def test_tile_sql_over_stored_tables(spark, run):
    from tunestats.plans import report_sql, reports
    g = lambda n: _t(spark, n)
    kpis = reports.report_kpis(g("gold_user_listening_summary"))
    frames = {
        "tile_genre_plays": reports.tile_genre_plays(reports.report_genre_trends(g("gold_genre_trends"))),
        "tile_artist_minutes": reports.tile_artist_minutes(reports.report_top_artists(g("gold_top_artists"))),
        "tile_track_plays": reports.tile_track_plays(reports.report_top_tracks(g("gold_top_tracks"))),
        "tile_heatmap": reports.tile_heatmap(reports.report_day_parts(g("gold_listening_patterns"))),
        "tile_favourites": reports.tile_favourites(kpis),
        "tile_total_tracks": reports.tile_total_tracks(kpis),
        "tile_total_minutes": reports.tile_total_minutes(kpis),
    }
    for name, df in frames.items():
        sql = report_sql.run_report(spark, name, "tp_gold")
        assert sql.columns == df.columns, name
        assert sql.exceptAll(df).count() == 0 and df.exceptAll(sql).count() == 0, name


def test_second_run_leaves_no_stale_gold(spark):
    """A run whose plays have no genres publishes empty genre trends, first or
    later; the raw loader alone keeps a table for which nothing landed."""
    import json
    import os
    import tempfile
    root = tempfile.mkdtemp(prefix="tunestats-empty-")

    def land(n, genres):
        folders = {}
        pages = {
            "plays": {"items": [{"played_at": f"2024-01-15T10:00:{i:02d}Z", "track": {
                "id": "t1", "name": "T", "duration_ms": 1000, "artists": [{"id": "a1", "name": "A"}],
                "album": {"id": "b", "name": "B"}}, "context": {"type": "playlist"}} for i in range(n)]},
            "playlists": {"items": []}, "playlist_tracks": {"items": []},
            "tracks": {"tracks": [{"id": "t1", "name": "T", "popularity": 5, "duration_ms": 1000, "artists": [{"id": "a1", "name": "A"}]}]},
            "artists": {"artists": [{"id": "a1", "name": "A", "genres": genres}]}}
        for kind, page in pages.items():
            folders[kind] = f"{root}/landing-{n}/{kind}"
            os.makedirs(folders[kind])
            with open(f"{folders[kind]}/p.json", "w") as f:
                f.write(json.dumps(page) + "\n")
        return folders

    first = pipeline.run(spark, land(3, []), database="te1", root=f"{root}/t1")
    assert first["gold"]["gold_genre_trends"] == 0 and spark.table("te1_gold.gold_genre_trends").columns[0] == "genre"
    pipeline.run(spark, land(10, ["pop"]), database="te2", root=f"{root}/t2")
    assert spark.table("te2_gold.gold_genre_trends").first().total_plays == 10
    again = pipeline.run(spark, land(5, []), database="te2", root=f"{root}/t2")
    assert spark.table("te2_gold.gold_user_listening_summary").first().total_tracks == 5
    assert spark.table("te2_gold.gold_genre_trends").count() == 0
    assert again["bronze"]["bronze_playlists"] is None


def test_dated_landing_and_broken_pages(spark):
    """Days before the window are not read; broken pages are counted and kept."""
    import contextlib
    import io
    import json
    import os
    import tempfile
    from tunestats.sources import read_raw, window_start
    root = tempfile.mkdtemp(prefix="tunestats-dated-")
    landing = {k: f"{root}/{k}" for k in pipeline.LANDING_KEYS}

    def page(day, i):
        return json.dumps({"items": [{"played_at": f"2024-01-{day}T1{i}:00:00Z", "track": {"id": f"t{day}{i}", "name": "T", "duration_ms": 1}}]})

    def put(folder, *lines):
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/p.json", "w") as f:
            f.write("\n".join(lines) + "\n")

    for day in ("10", "14", "15"):
        put(f"{landing['plays']}/land_date=2024-01-{day}", page(day, 1), "{broken " + day, page(day, 2))
    for kind, body in (("playlists", {"items": []}), ("playlist_tracks", {"items": []}), ("tracks", {"tracks": []}), ("artists", {"artists": []})):
        put(landing[kind], json.dumps(body))
    run_ts = "2024-01-15T12:30:00Z"
    out = pipeline.run_bronze(spark, landing, database="td", root=f"{root}/t", run_ts=run_ts, mode="PERMISSIVE")
    assert out["bronze_play_history"] == 2 and out["bronze_corrupt_pages"] == 2
    assert {r.track_id for r in spark.table("td_bronze.bronze_play_history").collect()} == {"t151", "t152"}
    assert {r.page for r in spark.table("td_bronze.bronze_corrupt_pages").collect()} == {"{broken 14", "{broken 15"}
    since = F.to_date(window_start(run_ts))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        read_raw(spark, "bronze_play_history", landing["plays"], since=since).explain()
    assert "PartitionFilters: [isnotnull(land_date" in buf.getvalue()
    with pytest.raises(Exception):
        pipeline.run_bronze(spark, landing, database="td2", root=f"{root}/t2", run_ts=run_ts)
