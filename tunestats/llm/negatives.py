"""Hard negatives by length buckets and coordinate pruning (after LEMP).

Vectors become integers (``floor(scale * x)``), so every score is an exact inner
product. The rows are put in order of label and length once, and cut into
blocks of equal size; the anchors go to the blocks that can
hold something for them: positives are searched in blocks of the anchor's label,
negatives in blocks with another label whose longest row is long enough for the
least score wanted (Cauchy-Schwarz). Anchors are cut into parts, so a task
holds one block and streams one part of the anchors.

Inside a block rows are in buckets by decreasing length. A bucket keeps, for
each coordinate, its rows sorted by that coordinate of their direction. An
anchor with the threshold t (the least score that can still count) skips a
bucket whose greatest length times its own is below t; otherwise the
directions' cosine must be at least c = t / (its length * greatest length),
which bounds each coordinate: x_f lies in a_f c -+ sqrt((1 - a_f^2)(1 - c^2)). Of
the anchor's ``FOCUS`` largest coordinates the feasible slices of the sorted
lists are intersected by counting, and the rows in all of them are scored
exactly. Thresholds rise with what has been found. What blocks found is cut to
the best of each anchor by windows over at most ``k`` rows a block.

Defined results: rows with a null id, label or vector, or a null or non-finite
component take no part, nor do empty vectors and vectors whose integer squared
length is 2^62 or more (their scores might not fit a long); vectors of
different lengths are never compared; repeated rows count each; equal scores
are ordered by id, then by label and row; without positives, or without rows in
the range of scores, an anchor has no row; an empty table gives an empty one;
other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunestats.llm.shared import shared_root, stored
from tunestats.operators import numbered

POSITIVES = 5             # positives of an anchor
NEGATIVES = 10            # negatives of an anchor and a positive
LOW, HIGH = 30, 90        # a negative's score, in hundredths of the positive's
SCALE = 256               # fixed value: integers for a component of 1
BLOCK_VALUES = 4 << 20    # components in a block
MAX_BLOCKS = 1 << 14      # blocks: beyond it they grow with the rows
PART_ANCHORS = 1 << 14    # anchors that a task streams
BUCKET = 4096             # most rows in a bucket of like lengths
NARROW = 0.9              # least length in a bucket, as a share of its greatest
FOCUS = 3                 # coordinates whose feasible slices are intersected
EXACT = float(1 << 53)    # products below it are exact in doubles
SLACK = 1e-9              # for rounding, in bounds of cosines

FOUND = "anchor_row long, wanted long, vec_id long, row long, label int, score long"
_FOUND = pa.schema([("anchor_row", pa.int64()), ("wanted", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()),
                    ("label", pa.int32()), ("score", pa.int64())])


def prepared(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
             label: Column | None = None) -> DataFrame:
    """vec_id, label, v (integers), square (their squared length) and dim of
    the rows that take part. ``label``: an expression instead of the column."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
    scaled = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), (F.col(label_col) if label is None else label).cast("int").alias("label"),
                       v.alias("_v"), F.aggregate(v, F.lit(0.0), lambda a, x: a + F.pow(F.floor(x.cast("double") * scale).cast("double"), F.lit(2.0))).alias("square"))
    # floor of a huge double saturates; such rows leave by their squared length first
    return rows.where(F.col("square") < float(1 << 62)).select(
        "vec_id", "label", F.transform("_v", lambda x: F.floor(x.cast("double") * scale)).alias("v"), "square", F.size("_v").alias("dim"))


def blocks(rows: DataFrame, block_values: int = BLOCK_VALUES) -> DataFrame:
    """``rows`` with ``row``, their place by (dim, label, length), and ``block``:
    a range of places. The places are written to the shared folder once."""
    total = rows.agg(F.sum("dim").alias("values"), F.count("*").alias("rows")).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    n = max(-(-(total["values"] or 0) // block_values), min(4 * cores, total["rows"] // 1024), 1)
    order = [F.asc("dim"), F.asc("label"), F.desc("square"), F.asc("_tie")]
    placed = numbered(rows.withColumn("_tie", F.monotonically_increasing_id()), order, shared_root(rows.sparkSession), "row")
    size = max(-(-total["rows"] // min(n, MAX_BLOCKS)), 1)
    return placed.drop("_tie").withColumn("block", F.floor((F.col("row") - 1) / size).cast("int"))


class Bucket:
    """Rows of like lengths: integers, directions and, for each coordinate
    asked for, the rows sorted by it."""

    def __init__(self, v: np.ndarray, length: np.ndarray, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray):
        self.v, self.length, self.ids, self.rows, self.labels = v, length, ids, rows, labels
        self.greatest = float(length[0])
        self.direction = v / np.maximum(length, 1e-300)[:, None]
        self.float_v = None
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_by(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.direction[:, f], kind="stable")
            self.lists[f] = order, self.direction[order, f]
        return self.lists[f]

    def candidates(self, direction: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray | None:
        """The rows in the feasible slices of all focus coordinates; None if
        these exclude nothing worth it."""
        if cosine <= 0:
            return None
        a = direction[focus]
        wide = np.sqrt(np.maximum(0.0, (1 - a * a) * (1 - cosine * cosine)))
        # beyond its own direction's coordinate a row may go up to 1 where a_f itself reaches the cosine
        low = np.where(-a >= cosine, -1.0, a * cosine - wide) - SLACK
        high = np.where(a >= cosine, 1.0, a * cosine + wide) + SLACK
        seen = np.zeros(len(self.ids), np.int8)
        for f, x, y in zip(focus, low, high):
            order, values = self.sorted_by(int(f))
            seen[order[np.searchsorted(values, x, "left"):np.searchsorted(values, y, "right")]] += 1
        picked = np.flatnonzero(seen == len(focus))
        return picked if len(picked) < len(seen) // 2 else None

    def scores(self, anchor: np.ndarray, length: float, picked: np.ndarray | None) -> np.ndarray:
        """Exact inner products: in doubles where no sum can be rounded."""
        if length * self.greatest < EXACT:
            if self.float_v is None:
                self.float_v = self.v.astype(np.float64)
            rows = self.float_v if picked is None else self.float_v[picked]
            return (rows @ anchor.astype(np.float64)).astype(np.int64)
        return (self.v if picked is None else self.v[picked]) @ anchor


def bucketed(v: np.ndarray, length: np.ndarray, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> list[Bucket]:
    """Buckets by decreasing length."""
    order, out, at = np.argsort(-length, kind="stable"), [], 0
    v, length, ids, rows, labels = (x[order] for x in (v, length, ids, rows, labels))
    while at < len(length):
        end = min(at + BUCKET, max(at + 1, int(np.searchsorted(-length, -NARROW * length[at], "right"))))
        if len(length) - end < BUCKET // 64:      # no crumbs at the end
            end = len(length) if len(length) - at <= 2 * BUCKET else end
        out.append(Bucket(*(x[at:end] for x in (v, length, ids, rows, labels))))
        at = end
    return out


class Best:
    """The ``k`` best rows within a range of scores, by score, id, label and row."""

    def __init__(self, k: int, low: float, high: float):
        self.k, self.low, self.high = k, low, high
        self.found = np.empty((0, 4), np.int64)        # -score, id, label, row: ascending

    def add(self, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        some = np.flatnonzero((scores >= self.low) & (scores <= self.high))
        if not len(some):
            return
        if len(some) > 4 * self.k:                     # ties with the last one stay
            limit = np.partition(scores[some], len(some) - self.k)[len(some) - self.k]
            some = some[scores[some] >= limit]
        new = np.stack((-scores[some], ids[some], labels[some], rows[some]), 1)
        found = np.concatenate((self.found, new))
        self.found = found[np.lexsort(found.T[::-1])[:self.k]]
        if len(self.found) == self.k:
            self.low = -int(self.found[-1, 0])


def search(buckets: list[Bucket], anchor: np.ndarray, length: float, own_row: int, label: int, same_label: bool, best: list[Best]) -> None:
    """Offer all rows of the buckets that can count to every one of ``best``."""
    direction = anchor / length if length else anchor.astype(np.float64)
    focus = np.argsort(-np.abs(direction), kind="stable")[:FOCUS]
    for bucket in buckets:
        least, reach = min(b.low for b in best), length * bucket.greatest
        if reach * (1 + SLACK) < least:
            return
        picked = bucket.candidates(direction, focus, least / reach - SLACK) if reach > 0 and np.isfinite(least) else None
        ids, rows, labels = (x if picked is None else x[picked] for x in (bucket.ids, bucket.rows, bucket.labels))
        scores = bucket.scores(anchor, length, picked)
        wanted = (labels == label) & (rows != own_row) if same_label else labels != label
        scores, ids, labels, rows = scores[wanted], ids[wanted], labels[wanted], rows[wanted]
        for b in best:
            b.add(scores, ids, labels, rows)


def matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def mined(rows: DataFrame, anchors: DataFrame, same_label: bool, k: int, low: int = LOW, high: int = HIGH) -> DataFrame:
    """The best ``k`` of every block: of the anchor's label (``wanted`` is 0
    then), or of other labels for each positive score in ``wanted``."""

    def go(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, buckets = None, [], None
        for batch in batches:
            names = {n: batch.column(n) for n in batch.schema.names}
            marks = np.stack([names[n].to_numpy() for n in ("block", "part", "dim")], 1)
            cuts = np.flatnonzero(np.any(marks[1:] != marks[:-1], axis=1)) + 1 if len(marks) else []
            for start, end in zip([0, *cuts], [*cuts, len(marks)]):
                if start == end:
                    continue
                here = tuple(marks[start])
                if here != place:
                    place, held, buckets = here, [], None
                given = {n: c.slice(start, end - start) for n, c in names.items()}
                is_row = given["wanted"].is_null().to_numpy(zero_copy_only=False)
                v, square = matrix(given["v"]), given["square"].to_numpy()
                ids, own, labels = (given[n].to_numpy() for n in ("vec_id", "row", "label"))
                if is_row.any():                       # a cell's rows come before its anchors
                    held.append([x[is_row] for x in (v, np.sqrt(square), ids, own, labels)])
                if is_row.all() or not held:
                    continue
                if buckets is None:
                    buckets = bucketed(*(np.concatenate(x) for x in zip(*held)))
                out: list[np.ndarray] = []
                for i in np.flatnonzero(~is_row):
                    wanted = given["wanted"][i].as_py()
                    best = [Best(k, -(-low * p // 100), high * p // 100) for p in wanted] if not same_label else [Best(k, -np.inf, np.inf)]
                    if best:
                        search(buckets, v[i], float(np.sqrt(square[i])), own[i], labels[i], same_label, best)
                    for p, b in zip(wanted, best):
                        lead = np.broadcast_to(np.array([own[i], p], np.int64), (len(b.found), 2))
                        out.append(np.concatenate((lead, b.found), 1))
                if out:
                    found = np.concatenate(out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (found[:, 0], found[:, 1], found[:, 3], found[:, 5], found[:, 4].astype(np.int32), -found[:, 2])], schema=_FOUND)

    # one row for each block, and for each length of vectors in it: at most MAX_BLOCKS and the number of lengths
    spans = rows.groupBy("block", "dim").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.max("square").alias("greatest"))
    if same_label:
        holds = (F.col("least") <= F.col("label")) & (F.col("label") <= F.col("most"))
    else:
        reach = F.sqrt("square") * F.sqrt("greatest") * (1 + SLACK)
        holds = ((F.col("least") != F.col("label")) | (F.col("most") != F.col("label"))) & (
            reach * 100 >= F.array_min("wanted").cast("double") * low)
    n_parts = -(-anchors.count() // PART_ANCHORS) or 1
    part = F.pmod(F.xxhash64("row"), F.lit(n_parts)).cast("int")
    sent = anchors.join(F.broadcast(spans), "dim").where(holds).select(
        "block", part.alias("part"), "dim", "vec_id", "row", "label", "v", "square", "wanted")
    kept = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1)))).select(
        "block", "part", "dim", "vec_id", "row", "label", "v", "square", F.lit(None).cast("array<bigint>").alias("wanted"))
    cells = max(rows.agg(F.max("block")).first()[0] or 0, 1) * n_parts
    both = kept.unionByName(sent).repartition(cells, "block", "part").sortWithinPartitions("block", "part", "dim", F.col("wanted").isNotNull())
    return both.mapInArrow(go, FOUND)


def first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_row", "wanted").orderBy(F.desc("score"), "vec_id", "label", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         block_values: int = BLOCK_VALUES) -> DataFrame:
    """``rows`` as from ``prepared``. For each anchor and each of its positives
    the first negatives: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score."""
    dealt = blocks(rows, block_values)
    anchors = dealt.where(is_anchor).drop("block")
    near = stored(first(mined(dealt, anchors.withColumn("wanted", F.array(F.lit(0).cast("long"))), True, positives), positives), "negatives-positives")
    # a range of scores is wanted once, whichever positives share their score; none lies under a negative one
    asked = near.where("score >= 0").groupBy("anchor_row").agg(F.collect_set("score").alias("wanted"))
    asking = stored(anchors.join(asked, anchors["row"] == asked["anchor_row"]).drop("anchor_row"), "negatives-anchors")
    far = first(mined(dealt, asking, False, negatives, low, high), negatives).select(
        "anchor_row", "wanted", F.col("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = near.select("anchor_row", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = asking.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    found = pairs.join(named, "anchor_row").join(far.withColumnRenamed("wanted", "positive_score"), ["anchor_row", "positive_score"])
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
