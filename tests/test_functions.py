from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tunestats import functions as fn


def test_parse_ts_valid_malformed_null(spark):
    df = spark.createDataFrame([("2024-01-07T10:30:00.250Z",), ("2024-01-07T10:30:00.123456",),
                                ("not-a-time",), (None,)], "s string")
    got = [r.t for r in df.select(fn.parse_ts("s").alias("t")).collect()]
    assert got[0] == datetime(2024, 1, 7, 10, 30, 0, 250000)
    assert got[1] == datetime(2024, 1, 7, 10, 30, 0, 123456)
    assert got[2] is None and got[3] is None


def test_time_attributes(spark):
    df = spark.createDataFrame([("2024-01-07T23:05:00Z",)], "s string").select(fn.parse_ts("s").alias("ts"))
    r = df.select(fn.hour_of_day("ts").alias("h"), fn.day_of_week_num("ts").alias("d"),
                  fn.weekday_name("ts").alias("w"), fn.month_name("ts").alias("m"),
                  fn.quarter("ts").alias("q"), fn.year("ts").alias("y"), fn.month_bucket("ts").alias("b")).first()
    assert (r.h, r.d, r.w, r.m, r.q, r.y, r.b) == (23, 1, "Sun", "Jan", 1, 2024, "2024-01")


def test_play_key_null_and_no_separator(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "x"), ("x", None)], "p string, t string")
    keys = [r.k for r in df.select(fn.play_key("p", "t").alias("k")).collect()]
    assert keys[0] == keys[1] and len(keys[0]) == 64
    assert keys[2] is None and keys[3] is None


def test_minutes_decimal_rounding(spark):
    df = spark.createDataFrame([(1,), (30001,), (60000,), (None,)], "ms bigint")
    out = df.select(fn.minutes("ms").alias("m"))
    assert str(out.schema["m"].dataType) == "DecimalType(28,7)"
    got = [r.m for r in out.collect()]
    assert got[0] == Decimal("0.0000167")      # 1/60000 = 0.00001666.. rounds half-up
    assert got[1] == Decimal("0.5000167")
    assert got[2] == Decimal("1.0000000")
    assert got[3] is None
    s = df.agg(F.sum(fn.minutes("ms")).alias("s"))
    assert str(s.schema["s"].dataType) == "DecimalType(38,7)"


def test_day_part_edges(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23, None]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    got = [r.p for r in df.select(fn.day_part("h").alias("p")).collect()]
    assert got == ["Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night"]


def test_first_or_null_and_nonempty_ids(spark):
    df = spark.createDataFrame(
        [([{"id": "a"}, {"id": "b"}],), ([],), (None,), ([{"id": ""}, None, {"id": None}, {"id": "z"}],)],
        "arr array<struct<id:string>>")
    got = df.select(fn.first_or_null("arr").getField("id").alias("f"),
                    fn.nonempty_ids("arr").alias("ids")).collect()
    assert [r.f for r in got] == ["a", None, None, ""]
    assert [r.ids for r in got] == [["a", "b"], [], None, ["z"]]


def test_typed_null(spark):
    df = spark.range(1).select(fn.typed_null("bigint").alias("x"))
    assert df.schema["x"].dataType.typeName() == "long" and df.first().x is None


def test_parse_ts_offsets_to_utc(spark):
    df = spark.createDataFrame([("2024-01-07T12:00:00+02:00",), ("2024-01-07T12:00:00-05:30",),
                                ("2024-01-07 12:00:00",)], "s string")
    got = [r.t for r in df.select(fn.parse_ts("s").alias("t")).collect()]
    assert got == [datetime(2024, 1, 7, 10, 0), datetime(2024, 1, 7, 17, 30), datetime(2024, 1, 7, 12, 0)]
