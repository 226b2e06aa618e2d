"""Are all pages there? Chains of landed pages, followed by their ``next``.

A listing is fetched page by page: each page carries its own address
(``href``) and that of the page after it (``next``, null on the last). From
what has landed, ``page_chains`` follows every chain to its end and tells how
it stands, so that a lost, repeated or circular page does not go unnoticed.

The walk is by pointer doubling: a page knows a later page ``to`` and what lies
before it; one self-join doubles the distance for all pages at once. A chain
of n pages takes about log2(n) joins, and no task holds a chain. Each round is
written to the shared folder, which ends its lineage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunestats import schemas
from tunestats.sources.pages import PAGE_KINDS, parse_pages, read_pages

#: How a chain stands, in order of precedence.
CYCLE, MISSING, HEADLESS, CONFLICT, MERGED, REPEATED, COMPLETE, UNADDRESSED = (
    "cycle", "missing", "headless", "conflict", "merged", "repeated", "complete", "unaddressed")


def _given(c: Column) -> Column:
    """An address, or null for an empty one."""
    return F.nullif(c, F.lit(""))


def _links(pages: DataFrame, keep: list[str | Column]) -> DataFrame:
    return pages.select(*keep, *(_given(F.col(c)).alias(n) for c, n in (("href", "page"), ("next", "next"), ("previous", "previous"))))


def read_links(spark: SparkSession, table: str, path: str | list[str], mode: str = "FAILFAST", multi_line: bool = False,
               since: Column | None = None) -> DataFrame:
    """(kind, page, next, previous) of every landed page of one kind; its
    items are not parsed."""
    if "next" not in PAGE_KINDS[table][0].fieldNames():
        raise ValueError(f"pages of {table} are answers to lists of ids, not parts of a listing")
    return _links(read_pages(spark, path, schemas.PAGE_LINK, mode, multi_line, since), [F.lit(table).alias("kind")])


def parse_links(df: DataFrame, text_col: str, kind_col: str = "kind", mode: str = "FAILFAST") -> DataFrame:
    """The same from a column of page text; ``kind_col`` tells listings apart."""
    return _links(parse_pages(df, text_col, schemas.PAGE_LINK, [kind_col], mode), [F.col(kind_col).alias("kind")])


def _nodes(links: DataFrame) -> DataFrame:
    """One row for each address. A page that has landed with different
    ``next``s is followed by the smallest (a page that went on, before one
    that ended there)."""
    told = F.coalesce("next", F.lit(""))
    return links.where(F.col("page").isNotNull()).groupBy("kind", "page").agg(
        F.count("*").alias("copies"), F.min("next").alias("next"), (F.min(told) != F.max(told)).alias("conflict"),
        F.bool_or(F.col("previous").isNull()).alias("first"))


def page_chains(links: DataFrame, root: str) -> DataFrame:
    """One row for each chain of ``links`` (kind, page, next, previous).

    chain: the address of its last page, or the smallest address of its cycle;
    status: ``cycle``; ``missing`` (its last page's ``next``, in column
    ``missing``, has not landed); ``headless`` (pages that no landed page leads
    to, though they have a ``previous``); ``conflict`` (a page landed with
    different ``next``s); ``merged`` (two pages lead to one); ``repeated`` (a
    page landed again); else ``complete``. n_pages, n_repeats (landings beyond
    each page's first), n_heads (pages that none leads to), n_headless and
    n_conflicts count them. Pages without an address are one row of each kind:
    chain null, status ``unaddressed``. An empty landing has no rows."""
    spark = links.sparkSession
    folder = f"{root}/chains-{uuid.uuid4().hex}"

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    nodes = stored(_nodes(links), "nodes")
    # whether a next has landed, and whether a page is led to: both sides by one address
    here = nodes.select("kind", F.col("page").alias("next"), F.lit(True).alias("landed"))
    led_to = nodes.where(F.col("next").isNotNull()).groupBy("kind", F.col("next").alias("page")).agg(F.count("*").alias("leaders"))
    # addresses compress well, so a small file is no small table: merged, not broadcast
    known = stored(nodes.join(here.hint("merge"), ["kind", "next"], "left").join(led_to.hint("merge"), ["kind", "page"], "left").select(
        "kind", "page", "next", "copies", "conflict", "first", F.coalesce("landed", F.lit(False)).alias("landed"),
        F.coalesce("leaders", F.lit(0)).alias("leaders")), "known")

    state = known.select("kind", "page", F.when(F.col("landed"), F.col("next")).alias("to"), F.col("page").alias("last"),
                         F.col("page").alias("least"))
    state, open_before, rounds = stored(state, "round-0"), None, 0
    going = F.col("to").isNotNull()
    while (still := state.where(going).count()) and still != open_before:
        # no page ended in a whole round: none lies further from an end, so what is left runs in circles
        open_before, rounds = still, rounds + 1
        state = stored(_doubled(state.where(going), state).unionByName(state.where(~going)), f"round-{rounds}")
    ended = state.where(~going).select("kind", "page", F.col("last").alias("chain"), F.lit(False).alias("cyclic"))
    circling = state.where(going)
    while still and (1 << rounds) <= still:        # until every path has gone round its cycle
        rounds += 1
        circling = stored(_doubled(circling, circling), f"round-{rounds}")
    # after that many steps ``to`` is on the cycle, and its own path all of it
    on_cycle = circling.select("kind", F.col("page").alias("to"), F.col("least").alias("chain"))
    found = ended.unionByName(circling.select("kind", "page", "to").join(on_cycle, ["kind", "to"]).select(
        "kind", "page", "chain", F.lit(True).alias("cyclic")))
    return _told(found.join(known.hint("merge"), ["kind", "page"])).unionByName(
        links.where(F.col("page").isNull()).groupBy("kind").agg(F.count("*").alias("n_pages")).select(
            "kind", F.lit(None).cast("string").alias("chain"), F.lit(UNADDRESSED).alias("status"), "n_pages",
            *(F.lit(0).cast("long").alias(c) for c in ("n_repeats", "n_heads", "n_headless", "n_conflicts")),
            F.lit(None).cast("string").alias("missing")))


def _doubled(going: DataFrame, state: DataFrame) -> DataFrame:
    """The pages ``going`` on, as far as the page they lead to has come."""
    beyond = state.select("kind", F.col("page").alias("to"), F.col("to").alias("to2"), F.col("last").alias("last2"),
                          F.col("least").alias("least2"))
    return going.join(beyond.hint("merge"), ["kind", "to"]).select(
        "kind", "page", F.col("to2").alias("to"), F.col("last2").alias("last"), F.least("least", "least2").alias("least"))


def _told(pages: DataFrame) -> DataFrame:
    head, merged = F.col("leaders") == 0, F.col("leaders") > 1
    lost = F.col("next").isNotNull() & ~F.col("landed")
    sums = pages.groupBy("kind", "chain").agg(
        F.bool_or("cyclic").alias("_cyclic"), F.count("*").alias("n_pages"), F.sum(F.col("copies") - 1).alias("n_repeats"),
        F.count_if(head).alias("n_heads"), F.count_if(head & ~F.col("first")).alias("n_headless"),
        F.count_if("conflict").alias("n_conflicts"), F.bool_or(merged).alias("_merged"), F.max(F.when(lost, F.col("next"))).alias("missing"))
    status = (F.when(F.col("_cyclic"), CYCLE).when(F.col("missing").isNotNull(), MISSING).when(F.col("n_headless") > 0, HEADLESS)
              .when(F.col("n_conflicts") > 0, CONFLICT).when(F.col("_merged"), MERGED).when(F.col("n_repeats") > 0, REPEATED).otherwise(COMPLETE))
    return sums.select("kind", "chain", status.alias("status"), "n_pages", "n_repeats", "n_heads", "n_headless", "n_conflicts", "missing")
