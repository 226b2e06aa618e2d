import json
import os

from tunestats.sources import read_raw
from tunestats.streaming import ingest


def _write(folder, name, pages):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        for p in pages:
            fh.write(json.dumps(p) + "\n")


def _page(i0, n):
    return {"items": [{"played_at": f"2024-01-07T10:{i:02d}:00Z",
                       "track": {"id": f"t{i}", "artists": [{"id": "a"}]}} for i in range(i0, i0 + n)] + [None]}


def test_incremental_ingest_exactly_once(spark, scratch):
    landing, out, ckpt = f"{scratch}/landing", f"{scratch}/raw", f"{scratch}/ckpt"
    _write(landing, "p1.json", [_page(0, 5), _page(5, 3)])
    ingest(spark, "bronze_play_history", landing, out, ckpt).awaitTermination(120)
    assert spark.read.parquet(out).count() == 8
    _write(landing, "p2.json", [_page(20, 4)])
    ingest(spark, "bronze_play_history", landing, out, ckpt).awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == 12                         # the first file is not loaded again
    assert got.exceptAll(read_raw(spark, "bronze_play_history", landing)).count() == 0
    assert got.columns == read_raw(spark, "bronze_play_history", landing).columns


def test_ingest_all_kinds(spark, scratch):
    """Every kind of landed page streams into its raw table; the result
    equals the batch read of the same folder."""
    from tunestats import fixtures as fx
    from tunestats.plans.pipeline import LANDING_KEYS
    from tunestats.streaming import ingest_all
    from conftest import SF_SMALL
    landing = fx.land(spark, SF_SMALL, f"{scratch}/landing")
    root = landing["plays"].rsplit("/", 1)[0]
    for q in ingest_all(spark, root, f"{scratch}/raw", f"{scratch}/ckpt").values():
        q.awaitTermination(300)
    for kind, table in LANDING_KEYS.items():
        got = spark.read.parquet(f"{scratch}/raw/{table}")
        want = read_raw(spark, table, landing[kind])
        assert got.count() == want.count() > 0, table
        assert got.exceptAll(want).count() == 0, table
