from decimal import Decimal

from tunestats.plans import reports
from conftest import rows


def test_day_parts_and_heatmap(spark):
    pat = spark.createDataFrame(
        [("u", h, "Mon", Decimal(h)) for h in (0, 5, 6, 11, 12, 17, 18, 23)] + [("u", None, "Tue", Decimal(1))],
        "user_id string, hour_of_day int, weekday_name string, total_minutes decimal(38,7)")
    r = reports.report_day_parts(pat)
    got = [(x.weekday_name, x.time_period, x.total_minutes) for x in r.collect()]
    assert got == [("Mon", "Afternoon", Decimal(29)), ("Mon", "Evening", Decimal(41)), ("Mon", "Morning", Decimal(17)),
                   ("Mon", "Night", Decimal(5)), ("Tue", "Night", Decimal(1))]
    h = reports.tile_heatmap(r)
    assert rows(h, "weekday_name", "time_period", "sum_total_minutes")[0] == ("Mon", "Afternoon", Decimal(29))


def test_ranking_reports(spark):
    ta = spark.createDataFrame([(f"a{i}", f"n{i % 150}", i, 1, Decimal(i % 120)) for i in range(300)],
                               "artist_id string, artist_name string, total_plays bigint, unique_tracks bigint, "
                               "total_minutes decimal(38,7)")
    r = reports.report_top_artists(ta).collect()
    assert len(r) == 100 and r[0].total_minutes == Decimal(119)
    assert [x.total_minutes for x in r] == sorted([x.total_minutes for x in r], reverse=True)
    tile = reports.tile_artist_minutes(reports.report_top_artists(ta)).collect()
    assert tile[0].total_minutes == Decimal(119) and tile[0].artist_name is not None
    tt = spark.createDataFrame([(f"t{i}", f"n{i}", "a", i % 40, i) for i in range(200)],
                               "track_id string, track_name string, artist_name string, play_count bigint, popularity bigint")
    r = reports.report_top_tracks(tt).collect()
    assert len(r) == 100 and r[0].play_count == 39
    assert reports.tile_track_plays(reports.report_top_tracks(tt)).columns == ["track_name", "play_count"]


def test_genre_reports(spark):
    gt = spark.createDataFrame([(f"g{i % 15}", f"2024-{i % 12 + 1:02d}", i, 1.0, 1) for i in range(60)],
                               "genre string, month string, total_plays bigint, avg_popularity double, unique_users bigint")
    top = reports.report_top_genres(gt).collect()
    assert len(top) == 10 and top[0].genre == "g14" and top[0].total_plays == 14 + 29 + 44 + 59
    assert reports.report_genre_trends(gt).columns == ["month", "genre", "total_plays", "avg_popularity"]
    assert reports.tile_genre_plays(reports.report_genre_trends(gt)).columns == ["genre", "month", "total_plays"]


def test_kpi_tiles(spark):
    s = spark.createDataFrame([("default_user", 5, 2, Decimal("1.5"), "A", "T")],
                              "user_id string, total_tracks bigint, unique_artists bigint, "
                              "total_minutes decimal(38,7), favorite_artist string, top_track string")
    k = reports.report_kpis(s)
    assert k.columns == ["total_tracks", "unique_artists", "total_minutes", "favorite_artist", "top_track"]
    assert tuple(reports.tile_favourites(k).first()) == ("T", "A")
    assert reports.tile_total_tracks(k).first()[0] == 5
    assert reports.tile_total_minutes(k).first()[0] == Decimal("1.5")
