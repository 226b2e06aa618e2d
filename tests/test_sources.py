import json
import os

import pytest

from tunestats.sources import enrich, harvest_keys, read_raw, recent
from conftest import rows


def _land(folder, name, pages):
    path = os.path.join(folder, name)
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as fh:
        for p in pages:
            fh.write((p if isinstance(p, str) else json.dumps(p)) + "\n")
    return path


PLAY_PAGES = [
    {"items": [
        {"played_at": "2024-01-07T10:00:00Z", "track": {"id": "t1", "name": "One", "duration_ms": 1000,
         "artists": [{"id": "a1", "name": "A"}, {"id": "a2", "name": "B"}], "album": {"id": "al", "name": "L"}},
         "context": {"type": "playlist"}},
        None,
        {"played_at": "2024-01-07T11:00:00Z", "track": None, "context": None},
        {"played_at": "2024-01-07T12:00:00Z", "track": {"id": None, "artists": []}},
    ], "next": None},
    {"items": None},
    {},
]


def test_flatten_play_history(spark, scratch):
    df = read_raw(spark, "bronze_play_history", _land(scratch, "plays", PLAY_PAGES))
    got = rows(df, "played_at", "track_id", "artist_id", "artist_name", "album_name", "context_type", "duration_ms")
    assert got == sorted([
        ("2024-01-07T10:00:00Z", "t1", "a1", "A", "L", "playlist", 1000),
        ("2024-01-07T11:00:00Z", None, None, None, None, None, None),
        ("2024-01-07T12:00:00Z", None, None, None, None, None, None),
    ], key=lambda t: tuple((v is not None, str(v)) for v in t))


def test_malformed_page_fails_or_is_skipped(spark, scratch):
    path = _land(scratch, "bad", [PLAY_PAGES[0], "{not json"])
    with pytest.raises(Exception):
        read_raw(spark, "bronze_play_history", path).collect()
    assert read_raw(spark, "bronze_play_history", path, mode="PERMISSIVE").count() == 3


def test_flatten_playlists(spark, scratch):
    pages = [{"items": [
        {"id": "p1", "name": "Mix", "owner": {"display_name": "me"}, "tracks": {"total": 3}, "snapshot_id": "s"},
        {"id": "p2", "name": "Other", "followers": {"total": 10}, "tracks": {"total": 1}},
        {"id": None, "name": "no id"}, {"id": "", "name": "empty id"}, None,
    ], "next": "x"}]
    df = read_raw(spark, "bronze_playlists", _land(scratch, "pl", pages))
    assert rows(df, "playlist_id", "owner_name", "followers", "total_tracks") == [
        ("p1", "me", None, 3), ("p2", None, 10, 1)]


def test_flatten_playlist_tracks(spark, scratch):
    pages = [{"playlist_id": "p1", "items": [
        {"added_at": "2024", "added_by": {"id": "u"},
         "track": {"id": "t1", "artists": [{"id": "a1"}, {"id": ""}, None, {"id": "a3"}], "album": {"id": "al"},
                   "popularity": 5}},
        {"track": {"id": "t2", "artists": None}},
        {"track": None}, {"track": {"id": ""}}, {"track": {"name": "no id"}},
    ]}]
    df = read_raw(spark, "bronze_playlist_tracks", _land(scratch, "items", pages))
    assert rows(df, "playlist_id", "track_id", "artist_ids", "added_by") == [
        ("p1", "t1", ["a1", "a3"], "u"), ("p1", "t2", [], None)]


def test_flatten_tracks_and_artists(spark, scratch):
    tpages = [{"tracks": [
        {"id": "t1", "name": "One", "explicit": True, "popularity": 3, "artists": [{"id": "a", "name": "A"}],
         "album": {"id": "al", "name": "L", "release_date": "2001"}},
        None, {"id": "t2", "artists": []}]}]
    t = read_raw(spark, "bronze_tracks", _land(scratch, "tracks", tpages))
    assert rows(t, "track_id", "artist_id", "album_name", "release_date", "explicit", "preview_url") == [
        ("t1", "a", "L", "2001", True, None), ("t2", None, None, None, None, None)]
    apages = [{"artists": [{"id": "a", "name": "A", "genres": ["x", "y"], "followers": {"total": 4}, "popularity": 1},
                           None, {"id": "b", "genres": []}]}]
    a = read_raw(spark, "bronze_artists", _land(scratch, "artists", apages))
    assert rows(a, "artist_id", "genres", "followers") == [("a", ["x", "y"], 4), ("b", [], None)]


def test_recent_window_is_strict(spark):
    df = spark.createDataFrame([("2024-01-15T00:00:00Z",), ("2024-01-15T00:00:00.001Z",), ("2024-01-16T00:00:00Z",),
                                ("bad",), (None,)], "played_at string")
    got = [r.played_at for r in recent(df, "2024-01-16T00:00:00Z", 24).collect()]
    assert sorted(got) == ["2024-01-15T00:00:00.001Z", "2024-01-16T00:00:00Z"]


def test_harvest_and_enrich(spark):
    plays = spark.createDataFrame([("t1", "a1"), ("t1", None), (None, "a2"), ("", "")], "track_id string, artist_id string")
    items = spark.createDataFrame([("t2", ["a3", "a1"]), ("t1", [])], "track_id string, artist_ids array<string>")
    tk, ak = harvest_keys(plays, items)
    assert rows(tk) == [("t1",), ("t2",)]
    assert rows(ak) == [("a1",), ("a2",), ("a3",)]
    cat = spark.createDataFrame([("t1", "x"), ("t3", "y"), ("t2", "z")], "track_id string, name string")
    assert rows(enrich(cat, tk, "track_id")) == [("t1", "x"), ("t2", "z")]


def test_fixture_pages_flatten_to_stored_rows(spark):
    """The JSON page path and the one-item-per-row path give the same rows."""
    from tunestats import fixtures as fx
    from conftest import SF_SMALL
    pairs = [(fx.tracks_from_pages(spark, SF_SMALL), fx.tracks_raw(spark, SF_SMALL)),
             (fx.artists_from_pages(spark, SF_SMALL), fx.artists_raw(spark, SF_SMALL)),
             (fx.playlists_from_pages(spark, SF_SMALL), fx.playlists_raw(spark, SF_SMALL)),
             (fx.playlist_tracks_from_pages(spark, SF_SMALL), fx.playlist_tracks_raw(spark, SF_SMALL))]
    for a, b in pairs:
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_one_pretty_printed_page_per_file(spark, scratch):
    folder = os.path.join(scratch, "pretty")
    os.makedirs(folder)
    for i, page in enumerate(PLAY_PAGES[:1] * 3):
        with open(os.path.join(folder, f"page-{i}.json"), "w") as fh:
            json.dump(page, fh, indent=2)
    df = read_raw(spark, "bronze_play_history", folder, multi_line=True)
    assert df.count() == 9
