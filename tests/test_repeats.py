"""De-duplication of what occurs again only, and joins of bucketed tables."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tunestats import fixtures as fx
from tunestats.operators import dedupe, dedupe_repeats, repeats, split_repeats
from tunestats.plans import marts, model
from tunestats.sinks import clean_versions, ensure_schema, load_all


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def some(spark, n, keys, hot=0):
    ids = F.col("id")
    key = F.when(ids < hot, F.lit(None).cast("string")).otherwise((F.xxhash64(ids) % keys).cast("string"))
    return spark.range(n).select(key.alias("k"), (ids % 3).cast("string").alias("k2"), F.hash("id").alias("a"),
                                 F.array((ids % 7).cast("string")).alias("b")).repartition(6)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("n, keys, hot", [(3000, 100_000, 0), (3000, 40, 0), (3000, 5000, 1000), (1, 5, 1), (0, 5, 0)])
def test_same_rows_as_dedupe(spark, scratch, n, keys, hot):
    df = some(spark, n, keys, hot)
    assert same(dedupe_repeats(df, ["k", "k2"], scratch), dedupe(df, ["k", "k2"]))
    assert same(dedupe_repeats(df, ["k"], scratch, ["b", "a", "k2"]), dedupe(df, ["k"], ["b", "a", "k2"]))


def test_crowded_filter_changes_nothing(spark, scratch, monkeypatch):
    monkeypatch.setattr(repeats, "BITS_A_KEY", 0)
    df = some(spark, 60_000, 200_000)
    monkeypatch.setattr(repeats, "MAX_BITS", repeats.BITMAP_BITS)
    once, again = split_repeats(df, ["k"], scratch)
    really = df.groupBy("k").count().where("count > 1").agg(F.sum("count")).first()[0]
    assert again.count() > 1.5 * really and once.count() + again.count() == 60_000      # many single rows share a bit
    assert same(dedupe_repeats(df, ["k"], scratch), dedupe(df, ["k"]))


def test_rows_without_a_repeat_are_not_moved(spark, scratch):
    path = f"{scratch}/plays"
    fx.plays_li(spark, SF_SMALL).write.parquet(path)
    plays = spark.read.parquet(path)
    df = plays.withColumn("_key", F.concat("played_at", "track_id"))
    once, again = split_repeats(df, ["_key"], scratch)
    p = plan(once)
    assert "Aggregate" not in p and "Exchange hashpartitioning" not in p and "Sort" not in p
    assert again.count() < plays.count() / 5 and once.count() > 0
    p = plan(model.fct_plays(plays, scratch))
    aggregates = [i for i, line in enumerate(p.splitlines()) if "SortAggregate" in line]
    lines = p.splitlines()
    assert aggregates and all(any("getbit" in x for x in lines[i:]) for i in aggregates)   # only above the filter's bit
    assert same(model.fct_plays(plays, scratch), model.fct_plays(plays))


def test_no_repeats_at_all(spark, scratch):
    df = spark.range(50).withColumn("x", F.lit(1))
    once, again = split_repeats(df, ["id"], scratch)
    assert again is None and once is df


@pytest.fixture(scope="module")
def timed(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="tunestats-buckets-")
    ensure_schema(spark, "tbk", location=f"{root}/db")
    plays = fx.plays_li(spark, SF_SMALL)
    tables = {"fct_plays": model.fct_plays(plays), "dim_time": model.dim_time(plays),
              "dim_tracks": model.dim_tracks(fx.tracks_raw(spark, SF_SMALL)), "dim_artists": model.dim_artists(fx.artists_raw(spark, SF_SMALL))}
    rows = load_all(tables, "tbk", root=root, buckets={t: ("play_timestamp", 4) for t in ("fct_plays", "dim_time")})
    assert rows == {t: df.count() for t, df in tables.items()}
    return root


def wide(spark, time=True):
    return marts.base_analytics(*(spark.table(f"tbk.{t}") for t in ("fct_plays", "dim_tracks", "dim_artists", "dim_time")[:3 + time]))


def test_time_join_of_bucketed_tables_shuffles_neither_side(spark, timed):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")          # dim_time grows with the plays
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        df = wide(spark)
        p = plan(df)
        assert "SortMergeJoin" in p and "Exchange hashpartitioning" not in p
        assert df.where("play_timestamp IS NULL").count() > 0                  # malformed times keep their plays
        assert same(df, wide(spark, time=False))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_plays_without_a_time_are_not_dealt_out(spark, scratch):
    ensure_schema(spark, "tbk2", location=f"{scratch}/db")
    hot = spark.range(0, 4000, numPartitions=8).select("id", F.when(F.col("id") % 3 > 0, F.timestamp_seconds(F.col("id") % 9)).alias("at"))
    load_all({"hot": hot}, "tbk2", root=scratch, buckets={"hot": ("at", 4)})
    files = spark.table("tbk2.hot").where("at IS NULL").groupBy(F.input_file_name()).count().collect()
    assert len(files) == 8 and sum(r["count"] for r in files) == 1334
    assert spark.table("tbk2.hot").count() == 4000


def test_bucketed_versions_switch_and_are_removed(spark, scratch):
    ensure_schema(spark, "tbk3", location=f"{scratch}/db")
    for n in (10, 20, 30):
        load_all({"t": spark.range(n).withColumn("at", F.timestamp_seconds("id"))}, "tbk3", root=scratch, buckets={"t": ("at", 3)})
        assert spark.table("tbk3.t").count() == n
    held = lambda: [t.name for t in spark.catalog.listTables("tbk3") if t.name.startswith("t__v")]
    assert len(held()) == 3
    gone = clean_versions(spark, "tbk3.t", scratch, keep=1, older_than_hours=-1)
    assert len(gone) == 2 and len(held()) == 1 and spark.table("tbk3.t").count() == 30
    load_all({"t": spark.range(5)}, "tbk3", root=scratch)                      # another schema, no buckets
    assert spark.table("tbk3.t").columns == ["id"]
