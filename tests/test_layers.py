"""Layers behind one switch, refreshed by partition and kept up by a stream."""

import contextlib
import io
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tunestats import fixtures as fx
from tunestats.plans import marts, model, refresh
from tunestats.sinks import clean_layer, ensure_schema, layers, open_layer, publish_layer
from tunestats.streaming import keep_up


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def numbers(spark, n, run):
    return spark.range(n).select("id", (F.col("id") % 3).cast("string").alias("k"), F.lit(run).alias("run"))


def test_one_switch_changes_all_names(spark, scratch, monkeypatch):
    ensure_schema(spark, "tly", location=f"{scratch}/db")
    names = ["a", "b", "c"]
    assert publish_layer(spark, "tly", {n: numbers(spark, 5, 1) for n in names}, scratch) == dict.fromkeys(names, 5)
    before = open_layer(spark, "tly", scratch)
    seen = lambda: {r.run for n in names for r in spark.table(f"tly.{n}").collect()}
    assert seen() == {1}

    # a run that fails between the writes of its names, and one that fails before the switch
    broken = numbers(spark, 7, 2).withColumn("run", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        publish_layer(spark, "tly", {"a": numbers(spark, 7, 2), "b": broken, "c": numbers(spark, 7, 2)}, scratch, concurrency=1)
    assert seen() == {1}
    with monkeypatch.context() as m:
        m.setattr(layers, "_switch", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            publish_layer(spark, "tly", {n: numbers(spark, 7, 2) for n in names}, scratch)
    assert seen() == {1}
    # one that fails right after the switch, before any other catalog operation
    with monkeypatch.context() as m:
        m.setattr(layers, "_show", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            publish_layer(spark, "tly", {n: numbers(spark, 7, 3) for n in names}, scratch)
    assert seen() == {3}
    assert {r.run for n in names for r in before.table(n).collect()} == {1}        # a state that was opened stays


def test_only_touched_partitions_are_written(spark, scratch):
    ensure_schema(spark, "tly2", location=f"{scratch}/db")
    publish_layer(spark, "tly2", {"t": numbers(spark, 30, 1), "u": numbers(spark, 3, 1)}, scratch, {"t": "k"})
    first = open_layer(spark, "tly2", scratch)
    publish_layer(spark, "tly2", {"t": numbers(spark, 30, 2).where("k = '1'")}, scratch, {"t": "k"}, merge=True, ledger={"w": 4})
    now = open_layer(spark, "tly2", scratch)
    assert {p for p, v in now.parts("t").items() if v != first.parts("t")[p]} == {"p1"} and now.parts("u") == first.parts("u")
    assert (now.ledger("w"), now.ledger("x"), first.ledger("w"), now.names()) == (4, None, None, ["t", "u"])
    assert {(r.k, r.run) for r in spark.table("tly2.t").collect()} == {("0", 1), ("1", 2), ("2", 1)}
    assert same(spark.table("tly2.t"), now.table("t")) and now.count("t") == 30
    with contextlib.redirect_stdout(io.StringIO()) as out:
        spark.table("tly2.t").explain()
    assert "dynamicpruning" in out.getvalue()                                       # folders are pruned by the manifest
    gone = clean_layer(spark, "tly2", scratch, older_than_hours=-1)
    assert sum("/t/" in g for g in gone) == 1 and spark.table("tly2.t").count() == 30


def test_odd_partition_values_empty_tables_and_schemas(spark, scratch):
    ensure_schema(spark, "tly3", location=f"{scratch}/db")
    odd = spark.createDataFrame([("a b",), ("2024-01-15",), (None,), ("",), ("x/=é",)], "k string")
    publish_layer(spark, "tly3", {"t": odd, "none": odd.limit(0)}, scratch, {"t": "k", "none": "k"})
    assert same(spark.table("tly3.t"), odd) and spark.table("tly3.none").count() == 0 and spark.table("tly3.none").columns == ["k"]
    assert same(open_layer(spark, "tly3", scratch).table("t"), odd) and open_layer(spark, "tly3", scratch).table("none").count() == 0
    publish_layer(spark, "tly3", {"none": odd}, scratch, {"none": "k"}, merge=True)
    assert spark.table("tly3.none").count() == 5
    with pytest.raises(ValueError):
        publish_layer(spark, "tly3", {"t": spark.range(2)}, scratch, merge=True)
    publish_layer(spark, "tly3", {"t": spark.range(2)}, scratch)
    assert spark.table("tly3.t").columns == ["id"] and spark.table("tly3.t").count() == 2
    publish_layer(spark, "tly3", {"t": spark.range(0)}, scratch)
    assert spark.table("tly3.t").count() == 0 and spark.table("tly3.none").count() == 5


def test_a_touched_partition_without_rows_goes(spark, scratch):
    ensure_schema(spark, "tly4", location=f"{scratch}/db")
    publish_layer(spark, "tly4", {"t": numbers(spark, 9, 1)}, scratch, {"t": "k"})
    publish_layer(spark, "tly4", {"t": numbers(spark, 9, 2).where("k = '1'")}, scratch, {"t": "k"}, merge=True, touched=["p1", "p2"])
    assert {(r.k, r.run) for r in spark.table("tly4.t").collect()} == {("0", 1), ("1", 2)}
    publish_layer(spark, "tly4", {"t": numbers(spark, 0, 3)}, scratch, {"t": "k"}, merge=True, touched=["p0", "p1"])
    assert spark.table("tly4.t").count() == 0 and open_layer(spark, "tly4", scratch).names() == ["t"]
    publish_layer(spark, "tly4", {"t": numbers(spark, 2, 4)}, scratch, {"t": "k"}, merge=True)
    assert spark.table("tly4.t").count() == 2


@pytest.fixture(scope="module")
def dims(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="tunestats-dims-")
    for name, df in (("tracks", model.dim_tracks(fx.tracks_raw(spark, SF_SMALL))), ("artists", model.dim_artists(fx.artists_raw(spark, SF_SMALL)))):
        df.write.parquet(f"{root}/{name}")
    return spark.read.parquet(f"{root}/tracks"), spark.read.parquet(f"{root}/artists")


def check(spark, layer, plays, dims):
    base = marts.base_analytics(model.fct_plays(plays), *dims)
    assert same(refresh.fct_plays(layer), model.fct_plays(plays))
    assert same(refresh.genre_trends(layer), marts.genre_trends(base))
    assert same(refresh.listening_patterns(layer), marts.listening_patterns(base))


def test_a_new_day_rewrites_its_month_only(spark, scratch, dims):
    ensure_schema(spark, "trf", location=f"{scratch}/db")
    plays = fx.plays_li(spark, SF_SMALL)
    day = F.coalesce(F.col("played_at").startswith("1995-03-0"), F.lit(False))
    refresh.refresh(spark, plays.where(~day), *dims, "trf", scratch, ("run", 0))
    first = open_layer(spark, "trf", scratch)
    assert refresh.refresh(spark, plays.where(day), *dims, "trf", scratch, ("run", 1)) == ["1995-03"]
    now = open_layer(spark, "trf", scratch)
    for name in (refresh.FACT, refresh.GENRES, refresh.PATTERNS):
        assert {p for p, v in now.parts(name).items() if v != first.parts(name)[p]} == {"p1995-03"}
    check(spark, now, plays, dims)
    # the same batch again, and an older one: nothing changes
    assert refresh.refresh(spark, plays.where(day), *dims, "trf", scratch, ("run", 1)) == []
    assert refresh.refresh(spark, plays, *dims, "trf", scratch, ("run", 0)) == []
    assert open_layer(spark, "trf", scratch).rows == now.rows
    # without a number the plays are merged again and come out the same
    refresh.refresh(spark, plays.where(day), *dims, "trf", scratch)
    check(spark, open_layer(spark, "trf", scratch), plays, dims)
    refresh.rebuild(spark, *dims, "trf", scratch)
    check(spark, open_layer(spark, "trf", scratch), plays, dims)


def test_plays_without_key_or_time_over_batches(spark, scratch, dims):
    ensure_schema(spark, "trf2", location=f"{scratch}/db")
    schema = "played_at string, track_id string, track_name string, artist_id string, artist_name string, album_id string, " \
             "album_name string, context_type string, duration_ms long"
    rows = [(t, k, None, a, None, None, None, None, ms) for t, k, a, ms in [
        ("2024-01-05T10:00:00Z", "1", "2", 10), ("2024-01-05T10:00:00Z", "1", "1", 99), ("2024-02-01T00:00:00Z", None, "1", 5),
        (None, "3", "1", 7), ("2024-01-31T23:59:59Z", None, "2", 1), ("bad", "4", "1", 3), ("bad", "4", "0", 2), ("worse", "4", "1", 3)]]
    for i, row in enumerate(rows):
        refresh.refresh(spark, spark.createDataFrame([row], schema), *dims, "trf2", scratch, ("w", i))
    check(spark, open_layer(spark, "trf2", scratch), spark.createDataFrame(rows, schema), dims)
    refresh.refresh(spark, spark.createDataFrame([], schema), *dims, "trf2", scratch, ("w", 99))
    assert open_layer(spark, "trf2", scratch).ledger("w") == 99


def test_a_smaller_survivor_without_genres_takes_the_old_ones_away(spark, scratch, dims):
    """Plays without a key are one row; its genres go when a smaller row has none."""
    ensure_schema(spark, "trf3", location=f"{scratch}/db")
    known = dims[1].where("genres IS NOT NULL AND size(genres) > 0").select("artist_id").first().artist_id
    schema = "played_at string, track_id string, track_name string, artist_id string, artist_name string, album_id string, " \
             "album_name string, context_type string, duration_ms long"
    rows = [("2024-05-05T10:00:00Z", None, None, known, None, None, None, None, 5), (None, None, None, "no-such-artist", None, None, None, None, 5)]
    for i, row in enumerate(rows):
        refresh.refresh(spark, spark.createDataFrame([row], schema), *dims, "trf3", scratch, ("w", i))
        check(spark, open_layer(spark, "trf3", scratch), spark.createDataFrame(rows[:i + 1], schema), dims)
    assert refresh.genre_trends(open_layer(spark, "trf3", scratch)).count() == 0


def test_a_stream_keeps_up_and_replays_change_nothing(spark, scratch, dims):
    ensure_schema(spark, "tlv", location=f"{scratch}/db")
    page = lambda i: {"items": [{"played_at": f"2024-0{1 + j % 3}-07T10:{i:02d}:00Z", "track": {
        "id": f"{j}", "duration_ms": 1000 * j, "artists": [{"id": f"{j % 5}"}]}} for j in range(i, i + 9)]}
    landing, n = f"{scratch}/landing", 0

    def land(count):
        nonlocal n
        os.makedirs(landing, exist_ok=True)
        for _ in range(count):
            with open(f"{landing}/p{n}.json", "w") as f:
                f.write(json.dumps(page(n)) + "\n")
            n += 1

    def run():
        keep_up(spark, landing, *dims, "tlv", f"{scratch}/tables", f"{scratch}/ckpt", max_files_per_trigger=2).awaitTermination(300)

    from tunestats.sources import read_raw
    land(4)
    run()
    layer = open_layer(spark, "tlv", f"{scratch}/tables")
    assert layer.ledger(f"{scratch}/ckpt") == 1
    check(spark, layer, read_raw(spark, "bronze_play_history", landing), dims)
    land(1)
    run()
    # the commit of the last batch is lost: the stream hands it over again
    done = sorted(os.listdir(f"{scratch}/ckpt/commits"), key=lambda x: x.strip("."))
    for name in done:
        if name.strip(".").split(".")[0] == "2":
            os.rename(f"{scratch}/ckpt/commits/{name}", f"{scratch}/{name}.lost")
    before = open_layer(spark, "tlv", f"{scratch}/tables")
    run()
    after = open_layer(spark, "tlv", f"{scratch}/tables")
    assert after.rows == before.rows and after.ledger(f"{scratch}/ckpt") == 2
    check(spark, after, read_raw(spark, "bronze_play_history", landing), dims)
