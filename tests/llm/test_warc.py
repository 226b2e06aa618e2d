"""WARC: round trips, revisit rules, and archives that are broken."""

import gzip
import hashlib
import io
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tunestats.llm import registry, warc

SCHEMA = "page_id long, url string, html string, payload string"


def back(spark, rows, **kw):
    folder = tempfile.mkdtemp(prefix="warc-")
    warc.write(spark.createDataFrame(rows, SCHEMA), folder, **kw)
    return folder, sorted(warc.read(spark, folder).collect(), key=lambda r: (r.record_id is None, r.record_id or "", r.target_uri or ""))


def test_round_trip_and_revisits(spark):
    long = "é<p>" * 200_000
    rows = [(3, "u3", "same", "x"), (1, "u1", "same", "y"), (2, None, None, None), (4, "u 4\n", "", None),
            (5, "u5", long, ""), (None, "u6", "same", None), (1, "u1b", "same", None)]
    folder, got = back(spark, rows)
    assert [(r.record_id, r.record_type, r.refers_to) for r in got] == [
        ("1", "response", None), ("1", "response", None), ("2", "response", None), ("3", "revisit", "1"),
        ("4", "revisit", "2"), ("5", "response", None), (None, "revisit", "1")]
    assert all(r.digest_ok for r in got)
    assert got[5].payload.decode() == long and got[5].payload_bytes == len(long.encode())
    assert [r.payload_bytes for r in got if r.record_type == "revisit"] == [4, 0, 4]
    assert got[4].target_uri == "u%204%0A"
    # every record is a gzip member of its own
    import glob
    for path in glob.glob(f"{folder}/*.warc.gz"):
        assert gzip.open(path).read().count(b"WARC/1.1\r\n") == len(list(warc.read_records(open(path, "rb"))))


def test_smaller_payloads_stay_responses(spark):
    _, got = back(spark, [(1, "a", "xy", None), (2, "b", "xy", None), (3, "c", "xyz", None), (4, "d", "xyz", None)], min_bytes=3)
    assert [r.record_type for r in got] == ["response", "response", "response", "revisit"]


def test_empty_table(spark):
    assert back(spark, [])[1] == []


def test_many_copies(spark):
    df = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                  F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("html"))
    folder = tempfile.mkdtemp(prefix="warc-")
    warc.write(df, folder)
    got = warc.read(spark, folder, payloads=False)
    assert got.where("record_type = 'revisit' and refers_to = '0'").count() == 999 and got.count() == 3000


def test_reader_refuses_broken_archives():
    whole = warc.page_record(1, "u", b"body" * 1000, warc.base32_sha1(b"body" * 1000), None, "2024-01-01T00:00:00Z")
    assert len(list(warc.read_records(io.BytesIO(whole * 3)))) == 3
    assert list(warc.read_records(io.BytesIO(b""))) == []
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(whole[:-9])))
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(whole + b"junk")))
    plain = gzip.decompress(whole)
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(gzip.compress(plain + b"more"))))
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(gzip.compress(plain[:-10]))))
    bad = next(warc.read_records(io.BytesIO(gzip.compress(plain.replace(b"bodybody", b"bodyBODY", 1)))))
    assert not bad.block_ok and not warc._payload(bad)[2]


def test_query_whole_table(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    got = {r.page_id: r for r in registry.op5_warc(spark, SF_SMALL).collect()}
    assert len(got) == len(pages)
    first = {}
    for p in sorted(pages, key=lambda p: p.page_id):
        first.setdefault(p.html or "", p.page_id)
    for p in pages:
        data, r = (p.html or "").encode(), got[p.page_id]
        assert r.payload_bytes == len(data) and r.payload_digest == warc.base32_sha1(data) and r.digest_ok
        assert (r.record_type, r.refers_to) == (("response", None) if first[p.html or ""] == p.page_id else ("revisit", first[p.html or ""]))
        assert len(hashlib.sha1(data).digest()) == 20
