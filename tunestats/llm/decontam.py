"""Benchmark decontamination by SimHash windows.

Items are put in classes of like length. In a class of items of m words and
more, texts are cut into windows of m - s + 1 words every s words, so that a
passage that repeats an item holds a window wherever it begins; the item is
indexed with its s windows of that size, one for each phase. A window's
fingerprint is the 64-bit SimHash of its word pairs, from running bit counts,
so every window of a text costs the same. Fingerprints are found by a
multi-index: four blocks of 16 bits; two fingerprints within ``RADIUS`` = 15
differ in at most 3 bits of some block, and all such neighbours of an item's
block are in that block's table, so no pair within the radius is missed. A
text's last window ends with it, and a text shorter than a window is one.
Candidates within the radius are verified around their place in the text: the
weighted similarity of five-word shingles of the item and of some words in a
row must be at least 0.8 (a shingle of the item weighs the more, the fewer of all
items have it; one that the item does not have weighs as if no item had it).
All beginnings up to a quarter of the item and ``SHIFT`` words away are tried,
and from each all lengths whose weight can have that similarity, so words
may be missing or added, also at the ends of the text.

Words are runs of letters, digits and other non-ASCII characters in lower
case. Items are indexed ``ITEM_BLOCK`` or so at a time, ``SCAN_BLOCKS`` blocks in one
scan of the texts. A scan's items are all that the driver, the plan and a worker
hold; further items take further scans, whose hits are written to the shared
folder. How many items have a shingle is counted by Spark over all items, so
neither blocks nor scans show in the result.

Defined results: null and empty texts and items match nothing, nor do items of
fewer than five words, which have no shingle; an item is told once for each
text, at its most similar place (the first, then the shortest, of equal
ones); repeated items with
one id are told once, the most similar; rows of items with a null id are not
searched; repeated rows get equal results; the input's columns are kept and a
clashing output name is refused with ``ValueError``.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunestats.llm.shared import stored

ITEM_BLOCK = 500           # items in an index, about
SCAN_BLOCKS = 4            # indexes in one scan of the texts
RADIUS = 15
BLOCKS = 4                 # of 64 / BLOCKS bits each
SHINGLE = 5
SIMILAR = 0.8
SHIFT = 2
LONGEST_STEP = 16
RATIO = 1.2                # most to fewest words of a class, about
PART_WORDS = 1 << 16       # words whose bit counts are held at a time, about
RUN = 256                  # words whose counts are added up in a row
CELLS = 1 << 18            # places of a text that are weighed at a time
HITS = "array<struct<item_id:long,similarity:double,start_word:int,n_words:int>>"

_SPACED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's words, in order."""
    found = (text or "").lower().encode("utf-8").translate(_SPACED).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def _joined(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each n words in a row."""
    x = np.full(max(0, len(h) - n + 1), n, np.uint64)
    for j in range(n):
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[j:j + len(x)]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bit_counts(pairs: np.ndarray) -> np.ndarray:
    """Running counts of each bit (modulo 2**16, as differences are small)."""
    runs = -(-(len(pairs) + 1) // RUN)
    out = np.zeros((runs, RUN, 64), np.int16)
    bits = np.unpackbits(np.ascontiguousarray(pairs).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out.reshape(-1, 64)[1:len(pairs) + 1] = bits
    for j in range(1, RUN):                                # all runs side by side
        out[:, j] += out[:, j - 1]
    out[1:] += np.cumsum(out[:-1, -1], axis=0, dtype=np.int16)[:, None]
    return out.reshape(-1, 64)[:len(pairs) + 1]


def fingerprints(counts: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SimHashes of the windows of ``sizes`` words (one pair less)."""
    out = np.empty(len(starts), np.uint64)
    for i in range(0, len(starts), 1 << 13):
        s, pairs = starts[i:i + (1 << 13)], sizes[i:i + (1 << 13)] - 1
        ones = counts[s + pairs] - counts[s]
        out[i:i + len(s)] = np.packbits(ones > (pairs // 2)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _neighbours() -> np.ndarray:
    """Masks of up to RADIUS // BLOCKS bits of a block."""
    width = 64 // BLOCKS
    return np.array([sum(1 << b for b in c) for k in range(RADIUS // BLOCKS + 1) for c in combinations(range(width), k)], np.int64)


def blocks_of(prints: np.ndarray) -> list[np.ndarray]:
    width = 64 // BLOCKS
    return [((prints >> np.uint64(width * b)) & np.uint64((1 << width) - 1)).astype(np.int64) for b in range(BLOCKS)]


class MultiIndex:
    """All fingerprints within the radius of a query."""

    def __init__(self, prints: np.ndarray):
        self.prints, self.tables = prints, []
        masks = _neighbours()
        for values in blocks_of(prints):
            near = (values[:, None] ^ masks).ravel()
            order = np.argsort(near, kind="stable")
            first = np.searchsorted(near[order], np.arange((1 << 64 // BLOCKS) + 1))
            self.tables.append((first.astype(np.int64), (order // len(masks)).astype(np.int32)))

    def within(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, fingerprint) places of all pairs within the radius."""
        got = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for values, (first, members) in zip(blocks_of(queries), self.tables):
            low, count = first[values], first[values + 1] - first[values]
            ends = np.cumsum(count)
            for a, b in _parts(ends, 1 << 20):
                q = np.repeat(np.arange(a, b), count[a:b])
                at = np.arange(len(q)) + np.repeat(low[a:b] - (ends[a:b] - count[a:b] - (ends[a - 1] if a else 0)), count[a:b])
                p = members[at].astype(np.int64)
                near = np.bitwise_count(queries[q] ^ self.prints[p]) <= RADIUS
                got.append((q[near], p[near]))
        q, p = (np.concatenate(x) for x in zip(*got))
        both = np.unique(q * len(self.prints) + p) if len(q) else q
        return both // max(1, len(self.prints)), both % max(1, len(self.prints))


def _parts(ends: np.ndarray, size: int):
    """Ranges of queries whose hits number about ``size`` at most."""
    a = 0
    while a < len(ends):
        b = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + size, "right"))
        b = max(b, a + 1)
        yield a, b
        a = b


def class_of(n: int) -> int:
    """The fewest words of the class that items of ``n`` words are in. Classes
    are the same whatever items there are."""
    least = SHINGLE
    while (following := int(least * RATIO) + 1) <= n:
        least = following
    return least


@dataclass
class _Class:
    size: int                  # words in a window
    step: int
    span: int                  # words in the longest item
    index: MultiIndex
    item: np.ndarray           # of each fingerprint: item, and its window's place in it
    phase: np.ndarray


class Benchmark:
    """The index of one block of items; built once per worker. ``items`` is the
    number of all items, ``having`` tells of shingles how many of them have
    it; without these the block is all there is."""

    def __init__(self, ids: list[int], texts: list[str | None], items: int | None = None, having: dict[int, int] | None = None):
        self.given = (ids, texts, items, having)

    def __reduce__(self):
        return Benchmark, self.given

    def _build(self) -> None:
        ids, texts, items, having = self.given
        found = [(i, h) for i, t in zip(ids, texts) if len(h := words(t)) >= SHINGLE]
        found.sort(key=lambda x: len(x[1]))
        self.ids, self.words = [i for i, _ in found], [h for _, h in found]
        self.shingles = [Counter(_joined(h, SHINGLE).tolist()) for h in self.words]
        own = Counter(s for c in self.shingles for s in c)
        self.having = own if having is None else {s: having.get(s, 1) for s in own}
        self.items = len(found) if items is None else items
        self.all_shingles = np.array(sorted(own), np.uint64)
        self.keys = [np.array(sorted(c), np.uint64) for c in self.shingles]
        self.weights = [np.array([self.weight(s) for s in k.tolist()]) for k in self.keys]
        self.totals = [sum(self.weight(s) * x for s, x in c.items()) for c in self.shingles]
        self.foreign = math.log(1 + self.items)            # weight of a shingle that no item has
        self.classes = []
        a = 0
        while a < len(found):
            shortest = class_of(len(self.words[a]))
            b = next((k for k in range(a, len(found)) if class_of(len(self.words[k])) > shortest), len(found))
            step = min(LONGEST_STEP, max(1, shortest // 5))
            size = shortest - step + 1
            prints, item, phase = [], [], []
            for k in range(a, b):
                counts = bit_counts(_joined(self.words[k], 2))
                prints.append(fingerprints(counts, np.arange(step), np.full(step, size)))
                item += [k] * step
                phase += range(step)
            self.classes.append(_Class(size, step, len(self.words[b - 1]), MultiIndex(np.concatenate(prints)), np.array(item), np.array(phase)))
            a = b

    def weight(self, shingle: int) -> float:
        """Of a shingle of this block's items."""
        return math.log(1 + self.items / self.having[shingle])

    def similarity(self, item: int, part: np.ndarray) -> float:
        """Weighted Jaccard similarity of an item's shingles and those of
        some words of a text."""
        mine, other = self.shingles[item], Counter(_joined(part, SHINGLE).tolist())
        both = [(self.weight(s) if s in mine else self.foreign, mine.get(s, 0), other.get(s, 0)) for s in mine.keys() | other.keys()]
        total = math.fsum(w * max(x, y) for w, x, y in both)
        return math.fsum(w * min(x, y) for w, x, y in both) / total if total else 0.0

    def best_place(self, item: int, shingles: np.ndarray, low: int, high: int) -> tuple[float, int, int] | None:
        """(similarity, first shingle, shingles) of the most similar place that
        begins from ``low`` to ``high``, if it is similar enough."""
        total, keys = self.totals[item], self.keys[item]
        # no place has more shingles than this, each at its least weight
        most = int(total / SIMILAR / min(self.foreign, float(self.weights[item].min()))) + 1
        shingles = shingles[low:high + most + 1]
        at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
        mine = keys[at] == shingles
        weights = np.where(mine, self.weights[item][at], self.foreign)
        run = np.concatenate(([0.0], np.cumsum(weights)))
        # no place is heavier than this
        last = int(np.searchsorted(run, run[min(high - low, len(shingles))] + total / SIMILAR + 1e-6))
        shingles, mine, weights, run = shingles[:last], mine[:last], weights[:last], run[:last + 1]
        # the most similar place begins and ends with a shingle of the item
        begins, ends = np.flatnonzero(mine[:high - low + 1]), np.flatnonzero(mine) + 1
        if run[-1] < SIMILAR * total - 1e-6 or not len(begins):
            return None
        common = np.concatenate(([0.0], np.cumsum(weights * mine)))
        if common[-1] < SIMILAR * total - 1e-6:
            return None
        found, times = np.unique(shingles[mine], return_counts=True)
        exact = all(t <= self.shingles[item][f] for f, t in zip(found.tolist(), times.tolist()))
        best = (SIMILAR - 1e-9, 0, 0)
        rows = max(1, CELLS // len(ends)) if exact else 1
        for i in range(0, len(begins), rows):
            b = begins[i:i + rows]
            e = ends[np.searchsorted(run[ends], run[b[0]] + SIMILAR * total - 1e-6):np.searchsorted(run[ends], run[b[-1]] + total / SIMILAR + 1e-6, "right")]
            if not len(e):
                continue
            if exact:
                both = common[e] - common[b][:, None]
            else:                                          # shingles that the place has more often than the item count as often as there
                left, sums, at = dict(self.shingles[item]), [0.0], int(b[0])
                for s, w in zip(shingles[at:e[-1]].tolist(), weights[at:e[-1]].tolist()):
                    has = left.get(s, 0) > 0
                    sums.append(sums[-1] + w * has)
                    if has:
                        left[s] -= 1
                both = np.array(sums)[np.maximum(e - at, 0)][None]
            like = np.where(e > b[:, None], both / np.maximum(total + run[e] - run[b][:, None] - both, 1e-9), 0.0)
            k = int(np.argmax(like > like.max() - 1e-9))
            r, c = divmod(k, len(e))
            if like[r, c] > best[0] + 1e-9 * (best[2] > 0):
                best = (float(like[r, c]), int(b[r]), int(e[c] - b[r]))
        return (best[0], low + best[1], best[2]) if best[2] else None

    def search(self, texts: list[str | None]) -> list[list[tuple[int, float, int, int]]]:
        """Hits (item id, similarity, first word, words) of each text."""
        if not hasattr(self, "classes"):
            self._build()
        hashed = [words(t) for t in texts]
        out: list[list] = [[] for _ in texts]
        a = 0
        while a < len(hashed):                             # texts together, up to PART_WORDS
            b, total = a, 0
            while b < len(hashed) and (b == a or total + len(hashed[b]) <= PART_WORDS):
                total += len(hashed[b])
                b += 1
            self._search_part(hashed[a:b], out[a:b])
            a = b
        return out

    def _search_part(self, hashed: list[np.ndarray], out: list[list]) -> None:
        lengths = np.array([len(h) for h in hashed])
        begins = np.cumsum(lengths) - lengths
        whole = np.concatenate(hashed)
        if len(whole) < 2 or not self.classes:
            return
        counts = bit_counts(_joined(whole, 2))
        # places whose shingle some item has: without one among its shingles a
        # window's similarity is 0, whatever its fingerprint
        shingles = _joined(whole, SHINGLE)
        at = np.minimum(np.searchsorted(self.all_shingles, shingles), len(self.all_shingles) - 1)
        theirs = self.all_shingles[at] == shingles
        known = np.concatenate(([0], np.cumsum(theirs), np.zeros(SHINGLE - 1, np.int64)))
        known[len(shingles) + 1:] = known[len(shingles)]
        best: dict[tuple[int, int], tuple] = {}
        for c in self.classes:
            windows = np.where(lengths >= c.size, np.maximum(0, -(-(lengths - c.size) // c.step)) + 1, lengths >= SHINGLE)
            if not windows.sum():
                continue
            owner = np.repeat(np.arange(len(hashed)), windows)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
            sizes = np.minimum(c.size, lengths[owner])
            place = np.minimum(number * c.step, lengths[owner] - sizes)
            starts = begins[owner] + place
            q, p = c.index.within(fingerprints(counts, starts, sizes))
            first, away = starts[q] - c.phase[p], SHIFT + c.span // 4
            some = known[np.clip(first + 2 * away + c.span * 5 // 4, 0, len(whole))] > known[np.clip(first - away, 0, len(whole))]
            q, p = q[some], p[some]
            ranges: dict[tuple[int, int], list] = {}
            for text, at, item in sorted(set(zip(owner[q].tolist(), (place[q] - c.phase[p]).tolist(), c.item[p].tolist()))):
                away = SHIFT + len(self.words[item]) // 4
                low, high = max(0, at - away), min(at + away, int(lengths[text]) - SHINGLE)
                mine = ranges.setdefault((text, item), [])
                if mine and low <= mine[-1][1] + 1:        # near the place before
                    mine[-1][1] = max(high, mine[-1][1])
                elif low <= high:
                    mine.append([low, high])
            for (text, item), places in ranges.items():
                own = slice(begins[text], begins[text] + max(0, lengths[text] - SHINGLE + 1))
                for low, high in places:
                    got = self.best_place(item, shingles[own], low, high)
                    if not got:
                        continue
                    _, low, n = got
                    n += SHINGLE - 1
                    sim = self.similarity(item, hashed[text][low:low + n])
                    if sim >= SIMILAR and (-sim, low) < best.get((text, self.ids[item]), (1.0,))[:2]:
                        best[text, self.ids[item]] = (-sim, low, n)
        for (text, item), (sim, low, n) in sorted(best.items()):
            out[text].append((item, -sim, low, n))


def matches(df: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
            out_col: str = "matches") -> DataFrame:
    """``df`` with the items that each whole text holds (``HITS``)."""
    if out_col.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the input already has a column {out_col}")
    items = stored(items.select(items[item_id].cast("long").alias("id"), items[item_text].alias("text")).where("id is not null and text is not null"),
                   "decontam-items")
    total, shared = _shingle_counts(items)
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    if blocks <= SCAN_BLOCKS:
        return df.withColumn(out_col, _search_blocks(items, shared, total, blocks, range(blocks))(df[text_col]))
    if {c.lower() for c in df.columns} & {"_row", "_hits"}:
        raise ValueError("the input already has a column _row or _hits")
    # one scan after the other; the rows' numbers are written with them
    rows = stored(df.withColumn("_row", F.monotonically_increasing_id()), "decontam-rows")
    hits = None
    for k in range(0, blocks, SCAN_BLOCKS):
        search = _search_blocks(items, shared, total, blocks, range(k, min(k + SCAN_BLOCKS, blocks)))
        found = stored(rows.select("_row", search(F.col(text_col)).alias("_hits")).where(F.size("_hits") > 0), "decontam-hits")
        hits = found if hits is None else hits.unionByName(found)
    # a row has one entry for each scan at most
    of_row = hits.groupBy("_row").agg(F.flatten(F.collect_list("_hits")).alias("_hits"))
    return rows.join(of_row, "_row", "left").select(*df.columns, F.coalesce("_hits", F.array().cast(HITS)).alias(out_col))


def _shingle_counts(items: DataFrame) -> tuple[int, DataFrame]:
    """(items that have a shingle; (id, s, n) of their shingles that several
    items have, with the number of items)."""

    @F.arrow_udf("array<long>")
    def distinct(texts: pa.Array) -> pa.Array:
        found = [np.unique(_joined(h, SHINGLE)) if len(h := words(t.as_py())) >= SHINGLE else np.empty(0, np.uint64) for t in texts]
        places = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64)))

    every = stored(items.select("id", distinct("text").alias("s")), "decontam-shingles")
    each = every.select("id", F.explode("s").alias("s"))
    return every.where(F.size("s") > 0).count(), each.join(each.groupBy("s").agg(F.count("*").alias("n")).where("n > 1"), "s").distinct()


def _search_blocks(items: DataFrame, shared: DataFrame, total: int, blocks: int, some: range):
    """A function from a column of texts to their hits with the items of some blocks."""
    indexes = []
    for k in some:
        # about ITEM_BLOCK items, and of their shingles those that other items have too
        mine = F.pmod(F.xxhash64("id"), F.lit(blocks)) == k
        part = items.where(mine).collect()
        having = {r["s"] % (1 << 64): r["n"] for r in shared.where(mine).select("s", "n").distinct().collect()}
        indexes.append(_search_column(Benchmark([r["id"] for r in part], [r["text"] for r in part], total, having)))

    def hits(text: Column) -> Column:
        found = [search(text) for search in indexes]
        return found[0] if len(found) == 1 else F.concat(*found)

    return hits


def _search_column(index: Benchmark):
    @F.arrow_udf(HITS)
    def search(texts: pa.Array) -> pa.Array:
        hits = []
        for i in range(0, len(texts), 1000):
            hits += index.search(texts.slice(i, 1000).to_pylist())
        flat = [x for h in hits for x in h]
        cols = list(zip(*flat)) if flat else [(), (), (), ()]
        kinds = {"item_id": pa.int64(), "similarity": pa.float64(), "start_word": pa.int32(), "n_words": pa.int32()}
        structs = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds.values())], names=list(kinds))
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(h) for h in hits]))).astype(np.int32)), structs)

    return search


