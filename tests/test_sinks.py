import pytest
from pyspark.sql import functions as F

from tunestats import schemas
from tunestats.session import shared_dir
from tunestats.sinks import clean_versions, current_version, ensure_schema, load_all, publish, write_table, write_with_schema


def test_load_all_counts_and_skips_empty(spark, scratch):
    ensure_schema(spark, "t_sinks", location=f"{scratch}/db")
    n = load_all({"a": spark.range(5), "b": spark.range(3)}, database="t_sinks", root=scratch)
    assert n == {"a": 5, "b": 3}
    n = load_all({"a": spark.range(0), "b": spark.range(7)}, database="t_sinks", root=scratch, skip_empty=True)
    assert n == {"a": None, "b": 7}
    assert spark.table("t_sinks.a").count() == 5     # skipped: old contents stay
    assert spark.table("t_sinks.b").count() == 7     # overwritten


def test_overwrite_replaces_schema(spark, scratch):
    ensure_schema(spark, "t_sinks2", location=f"{scratch}/db")
    write_table(spark.range(2), "t_sinks2.x", path=f"{scratch}/x")
    write_table(spark.range(2).select(F.lit("s").alias("y")), "t_sinks2.x", path=f"{scratch}/x")
    assert spark.table("t_sinks2.x").columns == ["y"]


def test_write_with_schema_rows_and_dataframe(spark, scratch):
    ensure_schema(spark, "t_sinks3", location=f"{scratch}/db")
    write_with_schema(spark, [("p1", "n", "o", None, 3, "d", "s")], "t_sinks3.pl", schemas.BRONZE_PLAYLISTS,
                      path=f"{scratch}/pl")
    t = spark.table("t_sinks3.pl")
    assert t.schema == schemas.BRONZE_PLAYLISTS and t.count() == 1
    df = spark.createDataFrame([(1, "p2")], "total_tracks int, playlist_id string")
    write_with_schema(spark, df, "t_sinks3.pl2", schemas.BRONZE_PLAYLISTS, path=f"{scratch}/pl2")
    r = spark.table("t_sinks3.pl2").first()
    assert (r.playlist_id, r.total_tracks, r.followers) == ("p2", 1, None)


def test_publish_switches_versions(spark, scratch):
    ensure_schema(spark, "t_sinks4", location=f"{scratch}/db")
    assert publish(spark, spark.range(3), "t_sinks4.v", root=scratch) == 3
    first = current_version(spark, "t_sinks4.v")
    planned = spark.table("t_sinks4.v")                     # a reader planned before the switch
    assert publish(spark, spark.range(5), "t_sinks4.v", root=scratch) == 5
    assert first != current_version(spark, "t_sinks4.v") and spark.table("t_sinks4.v").count() == 5
    assert publish(spark, spark.range(2).selectExpr("'x' AS s"), "t_sinks4.v", root=scratch) == 2
    assert spark.table("t_sinks4.v").columns == ["s"]       # new schema, same single switch
    assert planned.count() == 3                             # its files are still there
    assert clean_versions(spark, "t_sinks4.v", scratch, older_than_hours=1) == []
    assert len(clean_versions(spark, "t_sinks4.v", scratch, keep=1, older_than_hours=-1)) == 2
    assert spark.table("t_sinks4.v").count() == 2


def test_empty_results_are_published_with_their_schema(spark, scratch):
    ensure_schema(spark, "t_sinks5", location=f"{scratch}/db")
    assert publish(spark, spark.range(0).selectExpr("id", "'x' AS s"), "t_sinks5.v", root=scratch) == 0
    assert spark.table("t_sinks5.v").columns == ["id", "s"] and spark.table("t_sinks5.v").count() == 0
    assert publish(spark, spark.range(4), "t_sinks5.v", root=scratch) == 4
    assert publish(spark, spark.range(0), "t_sinks5.v", root=scratch) == 0
    assert spark.table("t_sinks5.v").count() == 0           # no stale rows


def test_no_table_changes_if_one_write_fails(spark, scratch):
    ensure_schema(spark, "t_sinks6", location=f"{scratch}/db")
    names = ["a", "b", "c", "d", "e"]
    load_all({n: spark.range(1) for n in names}, database="t_sinks6", root=scratch)
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        load_all({n: broken if n == "c" else spark.range(2) for n in names}, database="t_sinks6", root=scratch)
    assert [spark.table(f"t_sinks6.{n}").count() for n in names] == [1] * 5


def test_a_plain_table_of_the_name_is_replaced(spark, scratch):
    ensure_schema(spark, "t_sinks7", location=f"{scratch}/db")
    write_table(spark.range(2), "t_sinks7.x", path=f"{scratch}/plain")
    assert publish(spark, spark.range(6), "t_sinks7.x", root=scratch) == 6
    assert spark.table("t_sinks7.x").count() == 6


def test_shared_dir_needs_a_setting(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Plain:
        conf = Conf()

    assert shared_dir(Plain(), "/some/where/") == "/some/where"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Plain())


def test_another_file_format_reaches_writer_and_reader(spark, scratch):
    """What stands in for table formats that are not on the classpath here."""
    ensure_schema(spark, "t_sinks8", location=f"{scratch}/db")
    load_all({"o": spark.range(7)}, database="t_sinks8", fmt="orc", root=scratch)
    assert spark.table("t_sinks8.o").count() == 7
    assert spark.read.orc(current_version(spark, "t_sinks8.o")).count() == 7
    with pytest.raises(Exception, match="delta"):
        load_all({"d": spark.range(7)}, database="t_sinks8", fmt="delta", root=scratch)
