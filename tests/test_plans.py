"""Plan regression checks over stored tables (the way the layers run)."""

import contextlib
import io
import re
import tempfile

import pytest

from tunestats import fixtures as fx
from tunestats.plans import marts, model
from tunestats.sinks import ensure_schema, load_all
from conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark):
    root = tempfile.mkdtemp(prefix="tunestats-plans-")
    ensure_schema(spark, "tpl", location=f"{root}/db")
    load_all({
        "fct_plays": model.fct_plays(fx.plays_li(spark, SF_SMALL)),
        "dim_tracks": model.dim_tracks(fx.tracks_raw(spark, SF_SMALL)),
        "dim_artists": model.dim_artists(fx.artists_raw(spark, SF_SMALL)),
    }, database="tpl", root=root)
    base = marts.base_analytics(spark.table("tpl.fct_plays"), spark.table("tpl.dim_tracks"),
                                spark.table("tpl.dim_artists"))
    load_all({"base_analytics": base}, database="tpl", root=root)
    return spark.table("tpl.base_analytics")


def test_star_join_over_stored_tables_has_no_shuffle(spark, stored):
    base = marts.base_analytics(spark.table("tpl.fct_plays"), spark.table("tpl.dim_tracks"),
                                spark.table("tpl.dim_artists"))
    p = _plan(base)
    assert p.count("BroadcastHashJoin") == 2 and "BuildRight" in p
    assert "Exchange hashpartitioning" not in p and "SortMergeJoin" not in p
    assert "dim_time" not in p


@pytest.mark.parametrize("name, exchanges", [
    ("top_tracks", 1), ("top_artists", 2), ("genre_trends", 1), ("listening_patterns", 1)])
def test_marts_are_hash_aggregates_with_pruned_scans(stored, name, exchanges):
    p = _plan(getattr(marts, name)(stored))
    assert "SortAggregate" not in p and "HashAggregate" in p
    assert len(re.findall(r"Exchange hashpartitioning", p)) == exchanges
    cols = re.search(r"FileScan parquet [\w.]*\[([^\]]*)\]", p).group(1)
    assert len(cols.split(",")) <= 6          # never the 13 columns of the wide table


def test_not_null_filters_reach_the_scan(stored):
    p = _plan(marts.top_tracks(stored))
    assert "PushedFilters: [IsNotNull(track_id)]" in p
    p = _plan(marts.genre_trends(stored))
    assert "size(genres" in p and "IsNotNull(genres)" in p


def test_dedupe_combines_before_the_shuffle(spark, stored):
    p = _plan(model.fct_plays(fx.plays_li(spark, SF_SMALL)))
    assert "partial_min" in p and p.count("Exchange hashpartitioning") == 1


def test_play_key_is_hashed_after_the_shuffle(spark, stored):
    p = _plan(model.fct_plays(fx.plays_li(spark, SF_SMALL)))
    assert 0 <= p.index("sha2(") < p.index("Exchange hashpartitioning")       # above it in the plan
    assert "sha2(" not in p[p.index("Exchange hashpartitioning"):]


def test_top_artists_shuffles_no_attributes(spark, stored):
    p = _plan(marts.top_artists(stored, artists=spark.table("tpl.dim_artists")))
    for line in p.splitlines():
        if "HashAggregate" in line:
            assert "genres" not in line and "artist_name" not in line
    a, b = marts.top_artists(stored, artists=spark.table("tpl.dim_artists")), marts.top_artists(stored)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_broadcast_bound_setting_controls_the_join(spark, stored):
    from tunestats.operators import BROADCAST_CONF
    fct, tr, ar = (spark.table("tpl.fct_plays"), spark.table("tpl.dim_tracks"), spark.table("tpl.dim_artists"))
    keys = {BROADCAST_CONF: "-1", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        p = _plan(marts.base_analytics(fct, tr, ar))
        assert p.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in p
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert _plan(marts.base_analytics(fct, tr, ar)).count("BroadcastHashJoin") == 2


def test_cluster_profile_applies(spark):
    from tunestats.session import CLUSTER_PROFILE, apply_cluster_profile
    old = {k: spark.conf.get(k, None) for k in CLUSTER_PROFILE}
    try:
        apply_cluster_profile(spark)
        assert all(spark.conf.get(k) == v for k, v in CLUSTER_PROFILE.items())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
