"""Session settings and the shared folder for lineage cuts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# SQL settings the builders rely on at scale. They are applied to a session
# with ``apply_scale_conf`` (runtime SQL confs only; nothing static).
SCALE_CONF = {
    # Derived hours, weekdays and months are computed in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, switch to a
    # broadcast join when a shuffled side turns out small, and split skewed
    # partitions of sort-merge joins (a hot track or artist, or the NULL key
    # of unmatched plays, on the fact side of a left join).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # What a task sorts or hashes is several times its share of a shuffle,
    # which is compressed, and a stage may hold several sorts at once.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # The stored plays take some 15 bytes each: of Spark's 128 MB a task would
    # read ten million, and what it groups would not stay in memory.
    "spark.sql.files.maxPartitionBytes": "32m",
    # A play key is 64 hex digits, which Spark's default codec stores as they
    # are and this one in about half.
    "spark.sql.parquet.compression.codec": "zstd",
}


# A starting profile for runs over ~100 TB of landed pages on ~1000 executors
# (apply with ``apply_cluster_profile``; values are sizes, not guarantees):
# * 1 GB input splits keep the scan near 100k tasks;
# * shuffles start at 20k partitions and adaptive execution coalesces them to
#   ~512 MB; the one full-fact shuffle (the de-duplication) then has 100k x
#   20k blocks, and its reducers may spill, which costs less than ten times as
#   many blocks of some KB would;
# * a partition counts as skewed from 5x the median and 1 GB up, and is split;
# * dimensions of up to 400 MB in memory are broadcast, which spares the fact
#   one full shuffle per dimension; run with spark.driver.maxResultSize of 2g
#   or more (a static setting), through which a broadcast passes.
CLUSTER_PROFILE = {
    "spark.sql.files.maxPartitionBytes": "1g",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "tunestats.broadcast.maxBytes": str(400 << 20),
}


def apply_cluster_profile(spark: SparkSession) -> SparkSession:
    """Apply ``CLUSTER_PROFILE`` on top of ``SCALE_CONF`` (runtime SQL
    settings only)."""
    apply_scale_conf(spark)
    for k, v in CLUSTER_PROFILE.items():
        spark.conf.set(k, v)
    return spark


def apply_scale_conf(spark: SparkSession, overwrite: bool = False) -> SparkSession:
    """Set ``SCALE_CONF`` keys that the session does not already set (or all
    of them with ``overwrite``). A cluster's own settings win by default,
    except the time zone, which results depend on."""
    for k, v in SCALE_CONF.items():
        current = spark.conf.get(k, None)
        if overwrite or current is None or k == "spark.sql.session.timeZone":
            spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tunestats",
                  shared: str | None = None) -> SparkSession:
    """A local session for tests and the bench (the Spark UI stays off).
    ``shared`` sets ``spark.checkpoint.dir`` (else Spark's own defaults do)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TUNESTATS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        # local runs keep the default database out of the working directory
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tunestats-warehouse-"))
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_scale_conf(spark)


def shared_dir(spark: SparkSession, root: str | None = None) -> str:
    """The folder that driver and executors share: ``root`` if given, else
    the setting ``spark.checkpoint.dir``, which the cluster names. There is
    no fallback to a folder of one machine; without either this raises."""
    path = root or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("no shared folder: set spark.checkpoint.dir to a folder that driver and executors "
                         "share, or pass root")
    return path.rstrip("/")
