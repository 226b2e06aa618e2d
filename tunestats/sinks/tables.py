"""Table sinks (SNK-1 … SNK-4).

Every layer is a full refresh that replaces rows and schema. ``publish`` and
``load_all`` write versions and point the table's name at the new one;
``write_table`` overwrites a plain table in place. The default format is
parquet; pass ``fmt`` for another file format that is on the classpath.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tunestats.operators import conform


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """SNK-4: ``CREATE SCHEMA IF NOT EXISTS`` (optionally at a location)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{loc}")


def write_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None,
                mode: str = "overwrite") -> None:
    """SNK-1: write ``df`` as table ``name`` (full refresh, schema replaced).

    With ``path`` the table's files live there (an external table), e.g. a
    folder on shared storage; otherwise in the catalog's warehouse."""
    w = df.write.format(fmt).mode(mode).option("overwriteSchema", str(mode == "overwrite").lower())
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


#: Properties of a published name that hold its current version's path, and
#: what the version is in SQL.
VERSION, SOURCE = "tunestats.version", "tunestats.source"


def _table_root(spark: SparkSession, full_name: str, root: str | None) -> str:
    if root:
        return f"{root.rstrip('/')}/{full_name.split('.')[-1]}"
    db, _, table = full_name.rpartition(".")
    location = spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri
    return f"{location.rstrip('/')}/{table}"


def _property(spark: SparkSession, full_name: str, key: str) -> str | None:
    if not spark.catalog.tableExists(full_name):
        return None
    held = spark.sql(f"SHOW TBLPROPERTIES {full_name}").where(F.col("key") == key).first()
    return held["value"] if held else None


def current_version(spark: SparkSession, full_name: str) -> str | None:
    """The folder that a published name reads, ``None`` if nothing is published."""
    return _property(spark, full_name, VERSION)


def stored(spark: SparkSession, full_name: str) -> DataFrame:
    """A published table's current version as its files hold it, without what
    its view makes of them; a plain table as it is."""
    source = _property(spark, full_name, SOURCE)
    return spark.sql(f"SELECT * FROM {source}") if source else spark.table(full_name)


def _version_table(full_name: str, version: str) -> str:
    """The catalog entry that holds the bucketing of a version."""
    return f"{full_name}__{version.rstrip('/').rpartition('/')[2].replace('-', '_')}"


def write_parts(parts: Sequence[DataFrame], path: str, fmt: str = "parquet", name: str = "parts") -> int:
    """Write the frames into one new folder, each when the one before is written, so
    that of what they broadcast there is one at a time. Returns the rows, counted by
    an ``Observation`` of each write."""
    rows = 0
    for i, df in enumerate(parts):
        obs = Observation(f"rows_{name}_{i}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("append" if i else "errorifexists").save(path)
        rows += int(obs.get["rows"])
    return rows


def write_version(spark: SparkSession, df: DataFrame | Sequence[DataFrame], full_name: str, fmt: str = "parquet",
                  root: str | None = None, buckets: tuple | None = None) -> tuple[str, int]:
    """Write ``df`` once into a new version folder; readers see nothing of it
    yet. The rows are counted by an ``Observation`` of that write. Returns
    the folder and the rows. Several frames are written one after the other
    (``write_parts``).

    With ``buckets`` (column, number) the version is bucketed and sorted by
    that column, so that joins of two tables in the same buckets need no
    shuffle. A third member makes the table's rows of ``df``'s after they
    are dealt out (what can be made there need not be shuffled), a fourth is
    the column of the table as an expression over ``df``'s. Rows without a value there match nothing; they are written by the
    tasks that hold them, however many they are, and not dealt out."""
    version = f"{_table_root(spark, full_name, root)}/v-{uuid.uuid4().hex}"
    if buckets:
        return version, _write_buckets(df, full_name, fmt, version, *buckets)
    return version, write_parts([df] if isinstance(df, DataFrame) else df, version, fmt, full_name)


def _write_buckets(df: DataFrame, full_name: str, fmt: str, version: str, column: str, n: int,
                   finish: Callable[[DataFrame], DataFrame] = lambda rows: rows, value: Column | None = None) -> int:
    value = F.col(column) if value is None else value
    known, rows = value.isNotNull(), 0
    # dealt out as the buckets are: each task writes one file
    for part, mode in ((df.where(known).repartition(n, value), "errorifexists"), (df.where(~known), "append")):
        obs = Observation(f"rows_{full_name}_{mode}")
        (finish(part).observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode).option("path", version)
         .bucketBy(n, column).sortBy(column).saveAsTable(_version_table(full_name, version)))
        rows += int(obs.get["rows"])
    return rows


def switch(spark: SparkSession, full_name: str, version: str, fmt: str = "parquet", select: Sequence[str] = ("*",)) -> None:
    """Make ``version`` what the name reads: one catalog operation, whether
    or not the schema has changed, so there is no moment without the name.
    (A plain table of that name, from another writer, is dropped first.)
    ``select``: what the name shows of the version's columns."""
    if spark.catalog.tableExists(full_name) and spark.catalog.getTable(full_name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {full_name}")
    bucketed = _version_table(full_name, version)
    source = bucketed if spark.catalog.tableExists(bucketed) else f"{fmt}.`{version}`"
    spark.sql(f"CREATE OR REPLACE VIEW {full_name} TBLPROPERTIES ('{VERSION}' = '{version}', '{SOURCE}' = '{source}') "
              f"AS SELECT {', '.join(select)} FROM {source}")


def in_file_order(spark: SparkSession, full_name: str, name: str = "position", fmt: str = "parquet") -> DataFrame:
    """A published table with the place of each row, from 1, in its files:
    by the number of the task that wrote the file, then by row. A table that
    was written in an order is so read back in it; nothing is sorted but the
    files' row counts."""
    stored = spark.read.format(fmt).load(current_version(spark, full_name))
    file = F.col("_metadata.file_name")
    rows = stored.select("*", F.regexp_extract(file, r"^part-(\d+)", 1).cast("int").alias("_task"), file.alias("_file"),
                         F.col("_metadata.row_index").alias("_row"))
    before = Window.orderBy("_task", "_file").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each file
    starts = rows.groupBy("_task", "_file").count().select("_file", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(starts), "_file").select(*stored.columns, (F.col("_before") + F.col("_row") + 1).alias(name))


def publish(spark: SparkSession, df: DataFrame, full_name: str, fmt: str = "parquet",
            root: str | None = None, skip_empty: bool = False) -> int | None:
    """Write ``df`` once into a new version folder and make it the table.

    Readers see the old version until the new one is complete, and a job that
    fails mid-write leaves the name as it was. Earlier versions stay, so a
    query planned before the switch still finds its files; ``clean_versions``
    removes them by age. A result with no rows is published as an empty table
    with its schema, unless ``skip_empty``, which leaves the name alone and
    returns ``None``. Returns the rows written."""
    return load_all({full_name: df}, None, fmt, root, 1, skip_empty)[full_name]


def load_all(tables: Mapping[str, DataFrame | Sequence[DataFrame]], database: str | None = None, fmt: str = "parquet",
             root: str | None = None, concurrency: int = 4, skip_empty: bool = False,
             buckets: Mapping[str, tuple] | None = None,
             views: Mapping[str, Sequence[str]] | None = None) -> dict[str, int | None]:
    """SNK-2: publish each DataFrame (or the DataFrames that are its parts) as a table. With ``skip_empty`` (the raw
    loader's way) a DataFrame with no rows is skipped and its table keeps its
    previous contents. ``buckets`` names the (column, number) of tables that are
    stored in buckets (see ``write_version``), ``views`` what the name of a table
    selects from what is stored, if that is not all of it as it is.

    First all versions are written, up to ``concurrency`` of them as
    concurrent Spark jobs (the tables of one call are independent); only when
    every write has succeeded are the names switched, one after the other. If
    a write fails, no table has changed. Each table is computed exactly once:
    there is no separate emptiness or count job over the data. Returns the
    rows written per table (``None`` for skipped ones)."""
    if not tables:
        return {}
    first = next(iter(tables.values()))
    spark = (first if isinstance(first, DataFrame) else first[0]).sparkSession
    full = {name: f"{database}.{name}" if database else name for name in tables}

    def one(name: str) -> tuple[str, int]:
        return write_version(spark, tables[name], full[name], fmt, root, (buckets or {}).get(name))

    if concurrency <= 1 or len(tables) == 1:
        written = {name: one(name) for name in tables}
    else:
        with ThreadPoolExecutor(max_workers=min(concurrency, len(tables))) as pool:
            written = dict(zip(tables, pool.map(one, tables)))
    out: dict[str, int | None] = {}
    for name, (version, rows) in written.items():
        out[name] = None if skip_empty and not rows else rows
        if out[name] is not None:
            switch(spark, full[name], version, fmt, (views or {}).get(name, ("*",)))
    return out


def clean_versions(spark: SparkSession, full_name: str, root: str | None = None, keep: int = 2,
                   older_than_hours: float = 24.0) -> list[str]:
    """Remove versions of a published name that no reader should need any
    more: neither the current one, nor among the ``keep`` newest, nor younger
    than ``older_than_hours``. Returns the removed folders; a folder that
    cannot be removed raises."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(_table_root(spark, full_name, root))
    disk = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not disk.exists(folder):
        return []
    current = (current_version(spark, full_name) or "").rstrip("/").rpartition("/")[2]
    found = sorted(((x.getModificationTime(), x.getPath()) for x in disk.listStatus(folder)
                    if x.isDirectory() and x.getPath().getName().startswith("v-")), key=lambda v: -v[0])
    limit, gone = (time.time() - 3600 * older_than_hours) * 1000, []
    for at, path in found[max(1, keep):]:
        if at < limit and path.getName() != current:
            if not disk.delete(path, True):
                raise OSError(f"cannot remove {path}")
            spark.sql(f"DROP TABLE IF EXISTS {_version_table(full_name, path.getName())}")
            gone.append(path.toString())
    return gone


def write_with_schema(spark: SparkSession, data, name: str, schema: StructType, fmt: str = "parquet",
                      path: str | None = None) -> DataFrame:
    """SNK-3: write rows (a list of tuples / dicts) or a DataFrame with a
    declared schema. A DataFrame is conformed to the schema (cast, reorder,
    add missing columns as NULL, drop extras) rather than trusted."""
    df = spark.createDataFrame(data, schema) if isinstance(data, list) else conform(data, schema)
    write_table(df, name, fmt, path)
    return df
