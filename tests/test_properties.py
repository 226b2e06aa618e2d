"""Random small inputs: the Spark builders against a brute-force Python
model of the same semantics, and against themselves on shuffled input."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from datetime import datetime, timezone
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tunestats.plans import marts, model

PLAY_COLS = ("played_at string, track_id string, track_name string, artist_id string, artist_name string, "
             "album_id string, album_name string, context_type string, duration_ms bigint")


def _gen(seed: int):
    r = random.Random(seed)
    times = [f"2024-0{r.randint(1, 3)}-{r.randint(10, 28)}T{r.randint(0, 23):02d}:{r.choice(['00', '30'])}:00Z"
             for _ in range(12)] + [None, "bad"]
    tracks = [f"t{i}" for i in range(8)] + [None]
    artists = [f"a{i}" for i in range(6)] + [None]
    plays = [(r.choice(times), r.choice(tracks), None, r.choice(artists), None, r.choice(["x", None]), None,
              r.choice(["album", None]), r.choice([1, 59999, 60000, 90001, 123457, None]))
             for _ in range(r.randint(40, 120))]
    plays += r.sample(plays, 10)  # exact duplicates
    names = ["Same", "Other", "Third", None]
    dim_tracks = [(f"t{i}", r.choice(names), r.randint(0, 9)) for i in range(8) if r.random() < 0.8]
    genres = [None, [], ["pop"], ["pop", "rock"], ["rock", None]]
    dim_artists = [(f"a{i}", r.choice(["Alpha", "Beta", None]), r.choice(genres)) for i in range(6) if r.random() < 0.8]
    return plays, dim_tracks, dim_artists


# ------------------------------------------------------ brute-force model --
def _minutes(ms):
    return None if ms is None else (Decimal(ms) / Decimal(60000)).quantize(Decimal("0.0000001"), ROUND_HALF_UP)


def _dsum(values):
    vals = [v for v in values if v is not None]
    return sum(vals, Decimal(0)) if vals else None


def _parse(s):
    if s is None:
        return None
    try:
        return datetime.fromisoformat(s).astimezone(timezone.utc).replace(tzinfo=None)
    except ValueError:
        return None


def _nulls_first(row):
    return tuple((v is not None, v) for v in row)


def _model(plays, dim_tracks, dim_artists):
    # fct_plays: key, parse, smallest row per key (NULLs first)
    groups = defaultdict(list)
    for p in plays:
        played_at, track_id, _, artist_id, _, album_id, _, context, ms = p
        key = None if played_at is None or track_id is None else hashlib.sha256(
            (played_at + track_id).encode()).hexdigest()
        groups[key].append((_parse(played_at), track_id, artist_id, album_id, ms, context))
    fct = [(k, *min(rows, key=_nulls_first)) for k, rows in groups.items()]
    tr = {t: (n, pop) for t, n, pop in dim_tracks}
    ar = {a: (n, g) for a, n, g in dim_artists}
    base = []
    for play_id, ts, track_id, artist_id, _, ms, _ in fct:
        t = tr.get(track_id)
        a = ar.get(artist_id)
        base.append(dict(
            play_id=play_id, ts=ts, ms=ms,
            track_id=track_id if t else None, track_name=t[0] if t else None, popularity=t[1] if t else None,
            artist_id=artist_id if a else None, artist_name=a[0] if a else None, genres=a[1] if a else None,
            hour=ts.hour if ts else None, weekday=ts.strftime("%a") if ts else None,
            month=ts.strftime("%Y-%m") if ts else None))

    def top1(col):
        counts = defaultdict(int)
        for b in base:
            counts[b[col]] += 1
        return sorted(counts.items(), key=lambda kv: (-kv[1], kv[0] is None, kv[0] or ""))[0][0]

    summary = [("default_user", sum(1 for b in base if b["play_id"] is not None),
                len({b["artist_id"] for b in base if b["artist_id"] is not None}),
                _dsum(_minutes(b["ms"]) for b in base), top1("artist_name"), top1("track_name"))] if base else []

    tt = defaultdict(list)
    for b in base:
        if b["track_id"] is not None:
            tt[(b["track_id"], b["track_name"], b["artist_name"])].append(b)
    top_tracks = [(*k, sum(1 for b in v if b["play_id"] is not None), _dsum(_minutes(b["ms"]) for b in v),
                   max((b["popularity"] for b in v if b["popularity"] is not None), default=None))
                  for k, v in tt.items()]

    ta = defaultdict(list)
    for b in base:
        if b["artist_id"] is not None:
            ta[(b["artist_id"], b["artist_name"])].append(b)
    top_artists = [(*k, sum(1 for b in v if b["play_id"] is not None),
                    len({b["track_id"] for b in v if b["track_id"] is not None}),
                    _dsum(_minutes(b["ms"]) for b in v), tuple(v[0]["genres"]) if v[0]["genres"] is not None else None)
                   for k, v in ta.items()]

    gt = defaultdict(list)
    for b in base:
        for g in b["genres"] or []:
            if g is not None:
                gt[(g, b["month"])].append(b)
    genre = []
    for (g, m), v in gt.items():
        pops = [b["popularity"] for b in v if b["popularity"] is not None]
        genre.append((g, m, sum(1 for b in v if b["play_id"] is not None),
                      round(sum(pops) / len(pops), 9) if pops else None, 1))

    lp = defaultdict(list)
    for b in base:
        lp[(b["hour"], b["weekday"])].append(b)
    patterns = [("default_user", h, w, _dsum(_minutes(b["ms"]) for b in v)) for (h, w), v in lp.items()]
    return len(fct), summary, top_tracks, top_artists, genre, patterns


# ---------------------------------------------------------------- spark --
def _spark(spark, plays, dim_tracks, dim_artists, shuffle_seed=None):
    if shuffle_seed is not None:
        plays = plays[:]
        random.Random(shuffle_seed).shuffle(plays)
    p = spark.createDataFrame(plays, PLAY_COLS)
    if shuffle_seed is not None:
        p = p.repartition(5)
    fct = model.fct_plays(p)
    tr = model.dim_tracks(spark.createDataFrame(dim_tracks, "track_id string, track_name string, popularity bigint"))
    ar = model.dim_artists(spark.createDataFrame(dim_artists, "artist_id string, artist_name string, "
                                                              "genres array<string>"))
    base = marts.base_analytics(fct, tr, ar)

    def rows(df, fix=lambda r: r):
        return sorted((fix(tuple(r)) for r in df.collect()), key=_nulls_first_str)

    summary = [tuple(r) for r in marts.user_summary(base).collect()]
    tt = rows(marts.top_tracks(base))
    ta = rows(marts.top_artists(base), lambda r: (*r[:5], tuple(r[5]) if r[5] is not None else None))
    ge = rows(marts.genre_trends(base), lambda r: (r[0], r[1], r[2], round(r[3], 9) if r[3] is not None else None, r[4]))
    lp = rows(marts.listening_patterns(base))
    return fct.count(), summary, tt, ta, ge, lp


def _nulls_first_str(row):
    return tuple((v is not None, str(v)) for v in row)


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_builders_match_brute_force_and_ignore_input_order(spark, seed):
    plays, dim_tracks, dim_artists = _gen(seed)
    n, summary, tt, ta, ge, lp = _model(plays, dim_tracks, dim_artists)
    want = (n, summary, sorted(tt, key=_nulls_first_str), sorted(ta, key=_nulls_first_str),
            sorted(ge, key=_nulls_first_str), sorted(lp, key=_nulls_first_str))
    got = _spark(spark, plays, dim_tracks, dim_artists)
    assert got == want
    assert _spark(spark, plays, dim_tracks, dim_artists, shuffle_seed=seed) == got
