"""Random landed pages: Spark flattening against a small Python model of
the rules (skip null items, first artist, NULL-safe nested fields, keep only
non-empty artist ids, drop items without a track id)."""

import json
import os
import random

import pytest

from tunestats.sources import read_raw


def _maybe(r, value, p_missing=0.15, p_null=0.15):
    x = r.random()
    return "MISSING" if x < p_missing else None if x < p_missing + p_null else value


def _obj(**fields):
    return {k: v for k, v in fields.items() if v != "MISSING"}


def _artist(r):
    return _maybe(r, _obj(id=_maybe(r, r.choice(["a1", "a2", ""])), name=_maybe(r, "N")), 0.0, 0.15)


def _play_item(r):
    if r.random() < 0.1:
        return None
    track = _maybe(r, _obj(id=_maybe(r, r.choice(["t1", "t2", ""])), name=_maybe(r, "T"),
                           duration_ms=_maybe(r, r.randint(0, 10**6)),
                           artists=_maybe(r, [_artist(r) for _ in range(r.randint(0, 3))]),
                           album=_maybe(r, _obj(id=_maybe(r, "al"), name=_maybe(r, "L")))))
    return _obj(played_at=_maybe(r, "2024-01-07T10:00:00Z"), track=track,
                context=_maybe(r, _obj(type=_maybe(r, "playlist"))))


def _get(d, *path):
    for p in path:
        if not isinstance(d, dict) or p not in d or d[p] is None:
            return None
        d = d[p]
    return d


def _model_plays(pages):
    out = []
    for page in pages:
        for it in page.get("items") or []:
            if it is None:
                continue
            artists = _get(it, "track", "artists")
            first = artists[0] if artists else None
            out.append((_get(it, "played_at"), _get(it, "track", "id"), _get(it, "track", "name"),
                        _get(first, "id"), _get(first, "name"), _get(it, "track", "album", "id"),
                        _get(it, "track", "album", "name"), _get(it, "context", "type"),
                        _get(it, "track", "duration_ms")))
    return out


def _model_items(pages):
    out = []
    for page in pages:
        for it in page.get("items") or []:
            tid = _get(it, "track", "id")
            if it is None or not tid:
                continue
            ids = [a["id"] for a in (_get(it, "track", "artists") or []) if isinstance(a, dict) and a.get("id")]
            out.append((page.get("playlist_id"), tid, ids, _get(it, "added_by", "id")))
    return out


def _write(folder, pages):
    os.makedirs(folder)
    with open(os.path.join(folder, "pages.json"), "w") as fh:
        for p in pages:
            fh.write(json.dumps(p) + "\n")
    return folder


def _key(row):
    return tuple((v is not None, json.dumps(v)) for v in row)


@pytest.mark.parametrize("seed", [7, 8])
def test_random_play_pages(spark, scratch, seed):
    r = random.Random(seed)
    pages = [_obj(items=_maybe(r, [_play_item(r) for _ in range(r.randint(0, 8))], 0.05, 0.05))
             for _ in range(40)]
    df = read_raw(spark, "bronze_play_history", _write(f"{scratch}/p{seed}", pages))
    got = sorted((tuple(x) for x in df.collect()), key=_key)
    assert got == sorted(_model_plays(pages), key=_key)


@pytest.mark.parametrize("seed", [7, 8])
def test_random_playlist_item_pages(spark, scratch, seed):
    r = random.Random(seed)
    pages = []
    for i in range(30):
        items = []
        for _ in range(r.randint(0, 6)):
            track = _maybe(r, _obj(id=_maybe(r, r.choice(["t1", "t2", ""])),
                                   artists=_maybe(r, [_artist(r) for _ in range(r.randint(0, 3))])))
            items.append(None if r.random() < 0.1 else
                         _obj(track=track, added_by=_maybe(r, _obj(id=_maybe(r, "u")))))
        pages.append(_obj(playlist_id=f"p{i}", items=items))
    df = read_raw(spark, "bronze_playlist_tracks", _write(f"{scratch}/i{seed}", pages))
    got = sorted(((x.playlist_id, x.track_id, x.artist_ids, x.added_by) for x in df.collect()), key=_key)
    assert got == sorted(_model_items(pages), key=_key)
