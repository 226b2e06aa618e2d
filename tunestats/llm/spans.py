"""Places of pattern matches in a text, as DataFrame expressions.

A match's place is the sum of what lies before it: the text is split at the
matches, and the gaps' and matches' lengths (in code points) are added up. The
splitter and the extractor are the same regex engine, so both see the same
leftmost non-overlapping matches.

Sums over a text's matches run in blocks (of ``BLOCK``, or more where there are
many): an array that grows inside
a fold is copied with each step, so it only grows to a block, and the blocks
are put side by side at the end. No step walks a text from its start for each
match. The work is thus in proportion to a text's length and its matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,match:string>"
CONTEXT_SPAN = "struct<start:int,end:int,match:string,before:string,after:string>"
RANGE = "struct<start:int,end:int>"
RUN = "struct<from:int,to:int,kind:string>"
BLOCK = 128          # items folded into one array before it is put beside the others
CHUNK = 4096         # characters of a piece of text that is cut within


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold(items: Column, state: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """What the steps over ``items`` hand out, in order. ``step`` gives the next
    state and an array (of none or one element of type ``kind``) for a state and an item."""
    none = F.array().cast(f"array<{kind}>")

    def one(acc: Column, x: Column) -> Column:
        after, given = step(acc["state"], x)
        return F.struct(after.alias("state"), F.concat(acc["out"], given).alias("out"))

    def run(part: Column, begin: Column) -> Column:
        return F.aggregate(part, F.struct(begin.alias("state"), none.alias("out")), one)

    def in_blocks(size: Column) -> Column:
        def block(acc: Column, k: Column) -> Column:
            part = F.slice(items, k * size + 1, size)
            return let(run(part, acc["state"]), lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

        empty = F.struct(state.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        blocks = F.sequence(F.lit(0), ((F.size(items) - 1) / size).cast("int"))
        return F.aggregate(blocks, empty, block, lambda acc: F.flatten(acc["out"]))

    # taking a block out costs a pass over all items, so blocks grow with the root of their number
    many = let(F.greatest(F.lit(BLOCK), (2 * F.sqrt(F.size(items))).cast("int")), in_blocks)
    return F.when(F.size(items) <= BLOCK, run(items, state)["out"]).otherwise(many)


def find(text: Column, pattern: str, guard: Column | None = None, context: int = 0) -> Column:
    """array of (start, end, match); end is exclusive. ``guard`` is a cheap
    condition without which no match is possible. A null text has none. With
    ``context`` also ``before``, up to that many characters before the match, and
    ``after``, the character behind it or ''."""
    kind = CONTEXT_SPAN if context else SPAN
    begin = {"at": F.lit(0)} | ({"tail": F.lit("")} if context else {})

    def step(state: Column, x: Column) -> tuple[Column, Column]:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span, after = {"start": start, "end": end, "match": x["hit"]}, {"at": end}
        if context:
            before = F.right(F.concat(state["tail"], x["gap"]), F.lit(context))
            span |= {"before": before, "after": F.left(F.concat(x["gap2"], x["hit2"]), F.lit(1))}
            after["tail"] = F.right(F.concat(before, x["hit"]), F.lit(context))
        return F.struct(*(c.alias(n) for n, c in after.items())), F.array(F.struct(*(c.alias(n) for n, c in span.items())))

    def pieces(hits: Column) -> Column:
        def cut(gaps: Column) -> Column:
            own = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
            if not context:
                return own
            return F.transform(own, lambda x, i: F.struct(x["gap"].alias("gap"), x["hit"].alias("hit"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("gap2"),
                                                          F.coalesce(F.left(F.get(hits, i + 1), F.lit(1)), F.lit("")).alias("hit2")))
        return let(F.split(text, pattern, -1), cut)

    state = F.struct(*(c.alias(n) for n, c in begin.items()))
    found = let(let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), pieces), lambda p: fold(p, state, kind, step))
    return F.when(text.rlike(pattern) if guard is None else guard, found).otherwise(F.array().cast(f"array<{kind}>"))


def that_hold(spans: Column, holds: Callable[[Column], Column]) -> Column:
    """The spans whose match fulfils a condition."""
    return F.filter(spans, lambda s: holds(s["match"]))


def named(kind: str, order: int, spans: Column) -> Column:
    """The spans with their kind's name and place in the list of kinds."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def told(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def outermost(spans: Column) -> Column:
    """array of (start, end): the spans that are not inside another, by start."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"))))

    def step(reach: Column, s: Column) -> tuple[Column, Column]:
        end = -s["back"]
        inside = end <= reach
        return F.greatest(reach, end), F.when(inside, F.array().cast(f"array<{RANGE}>")).otherwise(
            F.array(F.struct(s["start"].alias("start"), end.alias("end"))))

    return let(ordered, lambda o: fold(o, F.lit(-1), RANGE, step))


def not_inside(spans: Column, others: Column, kind: str) -> Column:
    """The ``spans`` (of type ``kind``) that lie in none of ``others``, by start."""
    rows = F.concat(F.transform(others, lambda o: F.struct(o["start"].alias("start"), F.lit(0).alias("own"), o["end"].alias("end"), F.lit(None).cast(kind).alias("s"))),
                    F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(1).alias("own"), s["end"].alias("end"), s.alias("s"))))

    def step(reach: Column, x: Column) -> tuple[Column, Column]:
        # of the others that begin here or before, the furthest end
        none = F.array().cast(f"array<{kind}>")
        return (F.when(x["own"] == 0, F.greatest(reach, x["end"])).otherwise(reach),
                F.when((x["own"] == 1) & (x["end"] > reach), F.array(x["s"])).otherwise(none))

    return let(F.sort_array(rows), lambda r: fold(r, F.lit(-1), kind, step))


def redact(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by the kind of
    its first in square brackets. ``spans`` as from ``named``."""
    def step(reach: Column, s: Column) -> tuple[Column, Column]:
        run = F.struct(reach.alias("from"), s["start"].alias("to"), s["kind"].alias("kind"))
        return F.greatest(reach, s["end"]), F.when(s["start"] < reach, F.array().cast(f"array<{RUN}>")).otherwise(F.array(run))

    def written(chunks: Column) -> Column:
        def piece(start: Column, end: Column) -> Column:
            i, j = (start / CHUNK).cast("int"), (end / CHUNK).cast("int")
            at = lambda k: F.coalesce(F.get(chunks, k), F.lit(""))
            many = F.concat(F.substr(at(i), start % CHUNK + 1, F.lit(CHUNK)), F.array_join(F.slice(chunks, i + 2, F.greatest(j - i - 1, F.lit(0))), ""),
                            F.substr(at(j), F.lit(1), end % CHUNK))
            return F.when(i == j, F.substr(at(i), start % CHUNK + 1, end - start)).otherwise(many)

        runs = let(F.sort_array(spans), lambda o: fold(o, F.lit(0), RUN, step))
        parts = F.transform(runs, lambda r: F.concat(piece(r["from"], r["to"]), F.lit("["), F.upper(r["kind"]), F.lit("]")))
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(parts, ""), piece(last, F.length(text)))

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, let(chunks, written)).otherwise(text)
