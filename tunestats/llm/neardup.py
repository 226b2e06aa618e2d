"""MinHash near-duplicates by a signature-coordinate inverted join.

1. A text's set is its distinct word shingles; equal sets are one class, and
   only classes go on, so copies never become pairs.
2. A class has ``COORDS`` minimum hashes. Two sets of similarity 0.8 agree in
   32 of 40 on average; pairs that agree in at least ``MATCHES`` are retained
   (at similarity 0.8 a pair falls below 20 with probability 3e-6, and far less
   above).
3. Inverted join: a class is posted under coordinate-value pairs. Prefix: with
   all pairs in one global order, rarest first, two classes that agree in
   ``MATCHES`` coordinates share a pair among their first
   ``COORDS - MATCHES + 1``, so no more is posted, and pairs of very common
   values (boilerplate) are posted only by classes made mostly of such. Skip:
   pairs that a single class has need no posting at all.
4. Each list's most typical class is its hub; every member is compared with
   the hub (collisions counted on the full signatures, then the exact sets).
   Lists whose members are all connected by that are skipped; in the others
   members of different components are compared with one another, block by
   block, and only links come out of that.
   Every retained pair is thus verified or already connected, while a group of
   near copies costs comparisons in proportion to its size.
5. Verified links are joined into components by large-star/small-star rounds.

Steps are cut by tables in the shared folder; nothing but counts comes to the
driver. Hot keys (a copy's class, a hub, a
common value) meet either partial aggregation or sort-merge joins of written
tables, whose skewed partitions adaptive execution splits.

Defined results: a null text, an empty one and one without words have the
empty set, are linked with nothing and are their own component; a text with
fewer words than a shingle is one shingle; equal texts (repeated rows, ties)
share a class; a null id is never a component's name unless all its members
have null ids; rows that repeat an id are one document and stay or go
together; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunestats.llm.shared import shared_root

COORDS, MATCHES = 40, 20
BLOCK = 512               # members of a list in a block; blocks are compared pair by pair
FEW = 100_000             # classes to verify, up to which their ids are broadcast (16 bytes and an id each)
SPAN = 1 << 13            # shingles hashed at a time
_RNG = np.random.default_rng(20240101)
_MUL = _RNG.integers(1, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, COORDS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``size``-word shingles; A-Z are
    lower-cased, words are parted by ASCII white space."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(h))
    x = np.full(len(h) - size + 1, size, np.uint64)
    for j in range(size):
        x = _mix(x * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - size + 1 + j])
    return np.unique(x)


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(COORDS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), SPAN):
        low = np.minimum(low, (shingles[None, i:i + SPAN] * _MUL[:, None] + _ADD[:, None]).min(1))
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _lists(arrays: list[np.ndarray], kind) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.empty(0, kind)))


def signatures(text: Column, size: int) -> Column:
    """struct of the set's size, key and signature."""

    @F.arrow_udf("n long, key binary, sig array<int>")
    def made(texts: pa.Array) -> pa.Array:
        n, key, sig = [], [], []
        for t in texts:
            x = shingle_set(t.as_py(), size)
            n.append(len(x))
            key.append(set_key(x))
            sig.append(signature(x) if len(x) else np.empty(0, np.int32))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(key, pa.binary()), _lists(sig, np.int32)], names=["n", "key", "sig"])

    return made(text)


def sets(text: Column, size: int) -> Column:
    """struct of the set's key and its hashes."""

    @F.arrow_udf("key binary, shingles array<long>")
    def made(texts: pa.Array) -> pa.Array:
        got = [shingle_set(t.as_py(), size) for t in texts]
        return pa.StructArray.from_arrays([pa.array([set_key(x) for x in got], pa.binary()), _lists([x.view(np.int64) for x in got], np.int64)],
                                          names=["key", "shingles"])

    return made(text)


class _Tables:
    """Written steps in one folder of the shared place."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.k = spark, f"{shared_root(spark)}/neardup-{uuid.uuid4().hex}", 0

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        self.k += 1
        path = f"{self.root}/{self.k:02d}-{name}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)


def postings(classes: DataFrame) -> DataFrame:
    """(coord, key, weight, posted): the prefix of each class, rarest pairs
    first; weight is high for classes made of common pairs, and ``posted`` are
    all coords of the class's prefix in order."""
    every = classes.select("key", F.posexplode("sig").alias("at", "value")).select("key", F.xxhash64("at", "value").alias("coord"))
    shared = every.groupBy("coord").agg(F.count("*").alias("n")).where("n > 1")
    # COORDS rows of a class at most come together
    own = every.join(shared, "coord").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("n", "coord"))).alias("pairs"))
    alone = COORDS - F.size("pairs")
    posted = F.slice("pairs", 1, F.greatest(F.lit(COORDS - MATCHES + 1) - alone, F.lit(0)))
    weight = F.aggregate("pairs", F.lit(0.0), lambda a, p: a + F.log(p["n"].cast("double")))
    prefix = own.select("key", weight.alias("weight"), posted.alias("p")).select("key", "weight", F.col("p.coord").alias("posted"))
    return prefix.select(F.explode("posted").alias("coord"), "key", "weight", "posted")


def _alike(sig_a: str, sig_b: str, n_a: str, n_b: str) -> Column:
    """Can the sizes have the similarity, and do the signatures agree in
    ``MATCHES`` coordinates?"""
    same = F.aggregate(F.zip_with(sig_a, sig_b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda t, x: t + x)
    return (100 * F.least(n_a, n_b) >= 80 * F.greatest(n_a, n_b)) & (same >= MATCHES)


def agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of the pairs (a, b) those that are retained for verification."""
    side = lambda c: classes.select(F.col("key").alias(c), F.col("sig").alias(f"sig_{c}"), F.col("n").alias(f"n_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where(_alike("sig_a", "sig_b", "n_a", "n_b")).select("a", "b")


def _similar(set_a: str, set_b: str) -> Column:
    common = F.size(F.array_intersect(set_a, set_b))
    return 100 * common >= 80 * (F.size(set_a) + F.size(set_b) - common)


def full_sets(keys: DataFrame, classes: DataFrame, docs: DataFrame, size: int, tables: _Tables) -> DataFrame:
    """(key, shingles) of the classes named by ``keys``, from their texts."""
    # a class's text is that of its first document, told by id and the text's hash
    ids = tables.cut(classes.join(keys.distinct(), "key", "left_semi").select("id", "text_hash", F.col("key").alias("meant")), "wanted")
    few = ids.count() <= FEW
    own = docs.withColumn("text_hash", F.xxhash64("text"))
    full = own.join(F.broadcast(ids) if few else ids, own["id"].eqNullSafe(ids["id"]) & (own["text_hash"] == ids["text_hash"]), "inner")
    # written before the keys are compared, or the comparison would move below
    # the join and every document's set would be made
    full = tables.cut(full.select("meant", sets(F.col("text"), size).alias("s")), "sets")
    # repeated rows bring a set several times; written again, so that joins with it can be split at a hot key
    return tables.cut(full.where(F.col("s.key") == F.col("meant")).select(F.col("meant").alias("key"), "s.shingles").dropDuplicates(["key"]), "full")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, tables: _Tables) -> DataFrame:
    """The pairs whose full sets are at least 0.8 similar."""
    full = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("key")), classes, docs, size, tables)
    side = lambda c: full.select(F.col("key").alias(c), F.col("shingles").alias(f"set_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(_similar("set_a", "set_b")).select("a", "b")


def star_edges(edges: DataFrame, tables: _Tables) -> DataFrame:
    """Edges (u, v), v smaller, with the components of ``edges`` (a, b): rounds
    of large-star and small-star until every component is one star around its
    least key (or only so many rounds, which keep the components too)."""
    edges = tables.cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    while True:
        # a star forest: no key has two smaller neighbours, or a smaller and a larger one
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        seen = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not seen.agg(F.count_if(F.expr("up > 1 or (up > 0 and down > 0)")).alias("n")).first()["n"]:
            return edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written before they are joined, so that the join can be split at a hot centre
        least = tables.cut(both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u != v").distinct()
        large = tables.cut(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("low").alias("v"))
        edges = tables.cut(small.where("u != v").distinct(), "small")


def roots_of(edges: DataFrame) -> DataFrame:
    """(key, root): the smallest neighbour of every key that has a smaller one."""
    return edges.groupBy(F.col("u").alias("key")).agg(F.min("v").alias("root"))


def compare_cell(cell: pa.Table) -> pa.Table:
    """The links between members of different components in a pair of blocks.
    A pair that shares several lists is compared in full only in the first of
    them, by the order in which both are posted."""
    key, root = cell["key"].to_pylist(), np.unique(cell["root"].to_pylist(), return_inverse=True)[1]
    own, n, coord = cell["own"].to_numpy(), cell["n"].to_numpy(), cell["coord"][0].as_py()
    one_block = cell["x"][0].as_py() == cell["y"][0].as_py()
    sig = cell["sig"].combine_chunks().flatten().to_numpy().reshape(len(key), COORDS)
    shingles, posted = cell["shingles"], cell["posted"].to_pylist()
    found = []
    for i in range(len(key) - 1):
        fit = (root[i + 1:] != root[i]) & (100 * np.minimum(n[i + 1:], n[i]) >= 80 * np.maximum(n[i + 1:], n[i]))
        if not one_block:
            fit &= own[i + 1:] != own[i]
        near = np.flatnonzero(fit) + i + 1
        near = near[(sig[near] == sig[i]).sum(1) >= MATCHES]
        if not len(near):
            continue
        mine = shingles[i].values.to_numpy()
        for j in near.tolist():
            others = set(posted[j])
            if next(c for c in posted[i] if c in others) != coord:
                continue
            common = len(np.intersect1d(mine, shingles[j].values.to_numpy(), assume_unique=True))
            if 100 * common >= 80 * (n[i] + n[j] - common):
                found.append((key[i], key[j]))
    return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})


def rest_links(posted: DataFrame, roots: DataFrame, classes: DataFrame, docs: DataFrame, size: int, tables: _Tables) -> DataFrame:
    """Links between different components in one list, for lists that the
    hubs left in several (a list of two was settled by its hub). A list is
    compared in pairs of blocks of bounded size; signatures and full sets are
    compared where the blocks meet, so of a list whose members are alike but
    not similar no pairs come out."""
    named = posted.join(roots, "key", "left").select("coord", "key", "posted", F.coalesce("root", "key").alias("root"))
    split = named.groupBy("coord").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
    split = split.where("low != high and n > 2").select("coord", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    members = tables.cut(named.join(split, "coord"), "members")
    full = full_sets(members.select("key"), classes, docs, size, tables)
    rows = members.join(classes.select("key", "n", "sig").join(full, "key"), "key").select(
        "coord", "key", "root", "n", "sig", "shingles", "posted", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = rows.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")}).drop("other")
    return cells.groupBy("coord", "x", "y").applyInArrow(compare_cell, "a binary, b binary")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5) -> DataFrame:
    """id, n_shingles, component_id for every row of ``df``: documents linked
    directly or through others (similarity of their ``size``-word shingle sets
    at least 0.8) share the smallest id among them."""
    spark = df.sparkSession
    tables = _Tables(spark)
    docs = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    signed = tables.cut(docs.select("id", F.xxhash64("text").alias("text_hash"), signatures(F.col("text"), size).alias("s"))
                        .select("id", "text_hash", "s.*"), "signatures")
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "text_hash"))).alias("first")
    classes = signed.where("n > 0").groupBy("key").agg(first, F.min("text_hash").alias("any_text"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig"))
    # of a class whose documents have no id, that with the least hash stands for all
    classes = tables.cut(classes.select("key", F.col("first.id").alias("id"), F.coalesce("first.text_hash", "any_text").alias("text_hash"), "n", "sig"), "classes")
    posted = tables.cut(postings(classes), "postings")
    hubs = posted.select("coord", "weight", "key").groupBy("coord").agg(F.max(F.struct("weight", "key")).alias("hub"))
    stars = posted.select("coord", "key").join(hubs, "coord").select(F.col("key").alias("a"), F.col("hub.key").alias("b")).where("a != b").distinct()
    stars = tables.cut(agreeing(stars, classes), "stars")
    links = tables.cut(verified(stars, classes, docs, size, tables), "links")
    edges = star_edges(links, tables)
    roots = tables.cut(roots_of(edges), "roots")
    rest = tables.cut(rest_links(posted, roots, classes, docs, size, tables), "rest")
    known = edges.select(F.col("u").alias("a"), F.col("v").alias("b"))
    roots = roots_of(star_edges(rest.unionByName(known), tables))
    member = classes.select("key", "id").join(roots, "key", "left").select("key", "id", F.coalesce("root", "key").alias("root"))
    named = member.groupBy("root").agg(F.min("id").alias("component_id"))
    named = tables.cut(member.join(named, "root").select("key", "component_id"), "named")
    return signed.join(named, "key", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce(F.col("component_id"), F.col("id")).alias("component_id")).withColumnRenamed("id", id_col)
