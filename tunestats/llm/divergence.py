"""How the sources of a language differ in their words: a divergence audit by
single-pass in-memory indexing.

``runs`` reads each document once and builds block postings: for every (lang,
source) the occurrences of each term and the documents that hold it. When a
block's estimated memory is full, it is spilled as a term-sorted run, cut by
the hash shard of (lang, term); the next block starts empty. ``postings`` brings
a shard's runs together and merges them with a heap, term by term, into
frequencies; terms in fewer than ``MIN_DOCS`` documents of the language go
there. ``pair_values`` streams the kept terms once: starting from the value that
a pair of sources has if neither holds any term, each term that a source holds
corrects the pairs it is in.

A term's frequency in a group becomes p = 1 + floor(10^9 (count + 2) / (N + 2 V)),
with V kept terms of the language and N occurrences of them in the group. Two
frequencies differ by floor((p - q)^2 / (p + q)). All arithmetic is in integers.

Bounds: a block holds about ``RUN_BYTES``; a shard about the postings of some
thousand documents (their number grows with the corpus), of which a merge has
one piece a run decoded; a task's pair sums are written out whenever they reach
``SUMS`` matrices of ``TILE`` x ``TILE``. A hot source or term has one posting a
run before it is shuffled.

Defined results: null text, lang and source count as ''; a text without a term
makes its group known, no more; repeated rows and ids are documents each;
texts of any length are read whole, ``CUT`` bytes at a time; an empty table
gives an empty result; other columns of the input, whatever their names, take
no part.
"""

from __future__ import annotations

import heapq
import marshal
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, groupby
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunestats.llm.shared import stored

MIN_DOCS = 10             # documents of a language that a kept term is in
TOP_TERMS = 10            # terms reported for a group
SCALE = 1_000_000_000     # fixed value: of the smoothed frequencies
ADDED = 2                 # fixed value: added to every count
RUN_BYTES = 128 << 20     # estimated memory of a block before it is spilled
TERM_BYTES = 200          # memory of a term in a block besides its letters: table entries and a bytes object
PIECE = 4096              # postings of a run in one row
SHARD_DOCS = 2048         # documents for each hash shard
CUT = 1 << 20             # bytes of a text that are split into words at a time
TILE = 256                # sources in a block of sources
SUMS = 64                 # matrices of pair sums that a task holds

#: Letters A-Z become a-z, bytes of non-ASCII characters stay, all others part words.
FOLD = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 0x20 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))

RUN = "shard int, lang string, run string, part int, terms int, postings binary"
POSTINGS = "lang string, term string, lang_count long, sources array<string>, counts array<long>"
SUM = "lang string, source string, item string, value long"
_STRINGS, _LONGS = pa.list_(pa.string()), pa.list_(pa.int64())


def words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in parts of about ``CUT`` bytes."""
    folded, at = text.translate(FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + CUT)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


class Block:
    """Postings in memory: for each (lang, source) the documents of each term,
    and its occurrences beyond the first in a document."""

    def __init__(self):
        self.docs: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.more: dict[tuple[str, str], dict[bytes, int]] = defaultdict(dict)
        self.bytes = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        docs, more, own = self.docs[lang, source], self.more[lang, source], Counter()
        for part in words(text):
            own.update(part)
        known = len(docs)
        docs.update(own.keys())
        for term, n in own.items():
            if n > 1:
                more[term] = more.get(term, 0) + n - 1
        if own:     # terms new to the block, at the mean length of the text's terms
            self.bytes += (len(docs) - known) * (TERM_BYTES + sum(map(len, own)) // len(own))

    def spill(self, shards: int) -> Iterator[dict]:
        """The block as rows of a run: for each language and shard the columns
        (terms, sources, counts, documents) of its postings, by term."""
        by_lang: dict[str, list[str]] = defaultdict(list)
        for lang, source in self.docs:
            by_lang[lang].append(source)
        run = uuid.uuid4().hex
        for lang, own in by_lang.items():
            seed, terms, sources, counts, docs = crc32(lang.encode()), [], [], [], []
            for source in own:
                held, more = self.docs[lang, source], self.more[lang, source]
                terms += held
                sources += [source] * len(held)
                docs += held.values()
                counts += [n + more.get(t, 0) for t, n in held.items()]
            cells = np.fromiter((crc32(t, seed) for t in terms), np.int64, len(terms)) % shards
            order = pc.sort_indices(pa.table({"shard": cells, "term": pa.array(terms, pa.binary())}),
                                    sort_keys=[("shard", "ascending"), ("term", "ascending")]).to_numpy()
            shard, at = np.unique(cells[order], return_index=True)
            order = order.tolist()
            columns = [[column[i] for i in order] for column in (terms, sources, counts, docs)]
            for cell, start, end in zip(shard.tolist(), at.tolist(), [*at.tolist()[1:], len(order)]):
                for part, i in enumerate(range(start, end, PIECE)):
                    cut = slice(i, min(i + PIECE, end))
                    yield {"shard": cell, "lang": lang, "run": run, "part": part, "terms": cut.stop - i,
                           "postings": marshal.dumps([column[cut] for column in columns])}


def runs(docs: DataFrame, shards: int, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Term-sorted runs of the block postings of ``docs`` (lang, source, text)."""
    schema = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("run", pa.string()), ("part", pa.int32()),
                        ("terms", pa.int32()), ("postings", pa.binary())])

    def out(block: Block) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for row in block.spill(shards):
            rows.append(row)
            if len(rows) == 256:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            for lang, source, text in zip(batch.column(0), batch.column(1), batch.column(2).cast(pa.binary())):
                block.add(lang.as_py(), source.as_py(), text.as_py())
                if block.bytes >= run_bytes:
                    yield from out(block)
                    block = Block()
        yield from out(block)

    return docs.select("lang", "source", "text").mapInArrow(index, RUN)


def merge(pieces: dict[str, list[bytes]]) -> Iterator[tuple[bytes, int, int, dict[str, int]]]:
    """Heap-merge of a shard's runs: every term with its occurrences, its
    documents and its count by source."""
    merged = heapq.merge(*(chain.from_iterable(zip(*marshal.loads(p)) for p in parts) for parts in pieces.values()))
    for term, same in groupby(merged, itemgetter(0)):
        total, docs, by_source = 0, 0, {}
        for _, source, n, d in same:
            by_source[source] = by_source.get(source, 0) + n
            total += n
            docs += d
        yield term, total, docs, by_source


def postings(spilled: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row for each kept term of a language, with its count by source."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        lang, term, total, sources, counts = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(term, pa.string()), pa.array(total, pa.int64()), pa.array(sources, _STRINGS),
             pa.array(counts, _LONGS)], names=["lang", "term", "lang_count", "sources", "counts"])

    def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)))
        kept: list[tuple] = []
        for (_, lang), shard in groupby(rows, itemgetter(0, 1)):
            pieces: dict[str, list[bytes]] = defaultdict(list)
            for _, _, run, data in shard:
                pieces[run].append(data.as_py())
            for term, total, docs, by_source in merge(pieces):
                if docs >= min_docs:
                    sources = sorted(by_source)
                    kept.append((lang, term.decode(), total, sources, [by_source[s] for s in sources]))
                    if len(kept) == PIECE:
                        yield out(kept)
                        kept = []
        if kept:
            yield out(kept)

    dealt = spilled.repartition("shard", "lang").sortWithinPartitions("shard", "lang", "run", "part")
    return dealt.select("shard", "lang", "run", "postings").mapInArrow(merged, POSTINGS)


def frequency(count: str, total: str, terms: str) -> Column:
    """p of a count among ``total`` occurrences of ``terms`` terms (null without terms)."""
    return F.expr(f"CASE WHEN {terms} > 0 THEN 1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + {ADDED} AS DECIMAL(20,0)))"
                  f" div CAST({total} + {ADDED} * {terms} AS DECIMAL(20,0)) END")


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q))"""
    return F.call_function("div", (p - q) * (p - q), p + q)


def by_group(kept: DataFrame) -> DataFrame:
    """A row for each kept term and group that holds it."""
    return kept.select("lang", "term", "lang_count", F.explode(F.arrays_zip("sources", "counts")).alias("g")).select(
        "lang", "term", "lang_count", F.col("g.sources").alias("source"), F.col("g.counts").alias("count"))


def groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every (lang, source) of the documents with ``n`` (occurrences of kept
    terms), ``terms`` (V) and ``lang_n`` (occurrences in the language)."""
    own = by_group(kept).groupBy("lang", "source").agg(F.sum("count").alias("n"))
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_count").alias("lang_n"))
    found = docs.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(of_lang, "lang", "left")
    return found.fillna(0, ["n", "terms", "lang_n"])


def term_values(kept: DataFrame, known: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """For each group the ``top`` terms that it holds more often than its language."""
    p, q = frequency("count", "n", "terms"), frequency("lang_count", "lang_n", "terms")
    rows = by_group(kept).join(known, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    valued = rows.where("p > q").select("lang", "source", "item", apart(F.col("p"), F.col("q")).alias("value"))
    return ranked(valued).where(F.col("rank") <= top)


def ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def tiles(known: DataFrame, tile: int = TILE) -> DataFrame:
    """Pairs of blocks of at most ``tile`` sources of a language."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    blocks = known.withColumn("block", F.floor((place - 1) / tile)).groupBy("lang", "terms", "block").agg(
        F.sort_array(F.collect_list(F.struct("source", "n"))).alias("own"))
    return blocks.join(blocks.select("lang", F.col("block").alias("other"), F.col("own").alias("others")), "lang").where("block <= other")


class PairSums:
    """Sums of the corrections of a pair of source blocks."""

    def __init__(self, terms: int, own: list[dict], others: list[dict]):
        self.terms, self.own, self.others = terms, own, others
        self.p0 = [np.array([self.p(0, g["n"]) for g in side], np.int64) for side in (own, others)]
        self.place = [{g["source"]: (i, g["n"]) for i, g in enumerate(side)} for side in (own, others)]
        self.base = self.apart(self.p0[0][:, None], self.p0[1])
        self.sums = np.zeros(self.base.shape, np.int64)

    def p(self, count: int, n: int) -> int:
        return 1 + SCALE * (count + ADDED) // (n + ADDED * self.terms)

    @staticmethod
    def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // (p + q)

    def add(self, rows: list[tuple[list[str], list[int]]]) -> None:
        """The terms' corrections: their values less the base, for all pairs."""
        sides = []
        for p0, place in zip(self.p0, self.place):
            p = np.repeat(p0[None, :], len(rows), 0)
            for i, (sources, counts) in enumerate(rows):
                for source, count in zip(sources, counts):
                    if (at := place.get(source)) is not None:
                        p[i, at[0]] = self.p(count, at[1])
            sides.append(p)
        left, right = sides
        for k in range(left.shape[1]):
            self.sums[k] += self.apart(left[:, k:k + 1], right).sum(0) - len(rows) * self.base[k]

    def rows(self, lang: str, same: bool) -> Iterator[dict]:
        for i, j in zip(*np.nonzero(self.sums)):
            a, b, value = self.own[i]["source"], self.others[j]["source"], int(self.sums[i, j])
            if a != b:
                yield {"lang": lang, "source": a, "item": b, "value": value}
                if not same:
                    yield {"lang": lang, "source": b, "item": a, "value": value}


def pair_values(kept: DataFrame, known: DataFrame, tile: int = TILE) -> DataFrame:
    """For each group every other source of its language and how far apart
    they are over all kept terms."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def out(held: dict[tuple, PairSums]) -> Iterator[pa.RecordBatch]:
        for (lang, block, other), sums in held.items():
            if rows := list(sums.rows(lang, block == other)):
                yield pa.RecordBatch.from_pylist(rows, schema)

    def corrections(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, PairSums] = {}
        for batch in batches:
            names = {n: batch.column(n) for n in batch.schema.names}
            cells = defaultdict(list)
            for i, key in enumerate(zip(*(names[c].to_pylist() for c in ("lang", "block", "other")))):
                cells[key].append(i)
            for key, at in cells.items():
                if key not in held:
                    if len(held) >= SUMS:
                        yield from out(held)
                        held = {}
                    held[key] = PairSums(*(names[c][at[0]].as_py() for c in ("terms", "own", "others")))
                held[key].add([(names["sources"][i].as_py(), names["counts"][i].as_py()) for i in at])
        yield from out(held)

    cut = stored(tiles(known, tile), "divergence-tiles")
    found = kept.select("lang", "sources", "counts").join(cut, "lang").select(
        "lang", "block", "other", "terms", "own", "others", "sources", "counts").mapInArrow(corrections, SUM)
    moved = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("moved"))
    p0 = frequency("0", "n", "terms")
    side = known.select("lang", "terms", "source", p0.alias("p"))
    base = side.join(side.select("lang", F.col("source").alias("item"), F.col("p").alias("q")), "lang").where("source <> item")
    valued = base.join(moved, ["lang", "source", "item"], "left").select(
        "lang", "source", "item", (F.coalesce(F.col("terms") * apart(F.col("p"), F.col("q")), F.lit(0)) + F.coalesce("moved", F.lit(0))).alias("value"))
    return ranked(valued)


def audit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS,
          top: int = TOP_TERMS, run_bytes: int = RUN_BYTES, tile: int = TILE) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank."""
    docs = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang_col), ("source", source_col), ("text", text_col))))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = min(max(4 * partitions, docs.count() // SHARD_DOCS), (1 << 31) - 1)
    kept = stored(postings(runs(docs, shards, run_bytes), min_docs), "divergence-postings")
    known = stored(groups(docs, kept), "divergence-groups")
    parts = [("pair", pair_values(kept, known, tile)), ("term", term_values(kept, known, top))]
    pair, term = (rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, rows in parts)
    return pair.unionByName(term)
