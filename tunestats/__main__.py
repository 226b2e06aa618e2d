"""Command line: run one or more layers.

    python -m tunestats --landing /data/landing --root /shared/tunestats \\
        [--database tunestats] [--layers bronze,check,silver,gold] [--run-ts 2024-01-16T00:00:00Z]
        [--cluster-profile]

``--landing`` holds one folder per kind of page: plays, playlists,
playlist_tracks, tracks, artists. The layer ``check`` (not run by default)
tells what the landing lacks. The session comes from the environment
(``spark-submit`` settings); nothing is set beyond ``session.SCALE_CONF``
unless ``--cluster-profile`` is given.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tunestats.plans import pipeline
from tunestats.session import apply_cluster_profile


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="tunestats")
    ap.add_argument("--landing", help="folder with one sub-folder per kind of landed page")
    ap.add_argument("--root", help="shared folder for the tables' files")
    ap.add_argument("--database", default="tunestats")
    ap.add_argument("--layers", default="bronze,silver,gold")
    ap.add_argument("--run-ts", default=None, help="UTC instant of the run: plays before it less the window are left out (none: keep all plays)")
    ap.add_argument("--window-hours", type=int, default=24)
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--mode", default="FAILFAST", choices=("FAILFAST", "PERMISSIVE"), help="what a broken landed page does")
    ap.add_argument("--multi-line", action="store_true", help="landed files hold one page each, not one page per line")
    ap.add_argument("--cluster-profile", action="store_true",
                    help="apply session.CLUSTER_PROFILE (settings for ~100 TB runs)")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName("tunestats").getOrCreate()
    if a.cluster_profile:
        apply_cluster_profile(spark)
    layers = [x.strip() for x in a.layers.split(",") if x.strip()]
    out: dict = {}
    if {"bronze", "check"} & set(layers) and not a.landing:
        ap.error("--landing is needed for the bronze layer and its check")
    landing = {k: f"{a.landing}/{k}" for k in pipeline.LANDING_KEYS}
    if "bronze" in layers:
        out["bronze"] = pipeline.run_bronze(spark, landing, a.database, a.root, a.run_ts, a.window_hours, a.format, a.mode, a.multi_line)
    if "check" in layers:
        out["check"] = pipeline.run_check(spark, landing, a.database, a.root, a.format, a.mode, a.multi_line)
    if "silver" in layers:
        out["silver"] = pipeline.run_silver(spark, a.database, a.root, a.format)
    if "gold" in layers:
        out["gold"] = pipeline.run_gold(spark, a.database, a.root, a.format)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
