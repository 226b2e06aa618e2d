"""Chains of landed pages, and the requests that are still to be made."""

import json
import random
from collections import defaultdict

import pytest

from tunestats.sources import missing_requests, page_chains, parse_links, read_links

LINKS = "kind string, page string, next string, previous string"


def walked(rows):
    """Every chain by walking from each page, one page at a time."""
    out = []
    for kind in {r[0] for r in rows}:
        landed = defaultdict(list)
        for k, page, nxt, previous in rows:
            if k == kind and page is not None:
                landed[page].append((nxt, previous))
        after = {p: min((n for n, _ in v if n is not None), default=None) for p, v in landed.items()}
        leaders = defaultdict(set)
        for p, n in after.items():
            leaders[n].add(p)
        chains = defaultdict(list)
        for p in landed:
            seen, at = [p], after[p]
            while at in landed and at not in seen:
                seen.append(at)
                at = after[at]
            cyclic = at in landed
            chains[min(seen[seen.index(at):]) if cyclic else seen[-1], cyclic].append(p)
        for (chain, cyclic), pages in chains.items():
            repeats = sum(len(landed[p]) - 1 for p in pages)
            heads = [p for p in pages if not leaders[p]]
            headless = [p for p in heads if all(previous is not None for _, previous in landed[p])]
            conflicts = [p for p in pages if len({n for n, _ in landed[p]}) > 1]
            merged = any(len(leaders[p]) > 1 for p in pages)
            missing = max((after[p] for p in pages if after[p] is not None and after[p] not in landed), default=None)
            status = ("cycle" if cyclic else "missing" if missing else "headless" if headless else "conflict" if conflicts
                      else "merged" if merged else "repeated" if repeats else "complete")
            out.append((kind, chain, status, len(pages), repeats, len(heads), len(headless), len(conflicts), missing))
        if lost := sum(k == kind and page is None for k, page, *_ in rows):
            out.append((kind, None, "unaddressed", lost, 0, 0, 0, 0, None))
    return sorted(out, key=str)


def chains(spark, rows, root):
    return sorted((tuple(r) for r in page_chains(spark.createDataFrame(rows, LINKS), root).collect()), key=str)


def listing(kind, name, n):
    address = [f"{name}/{i}" for i in range(n)]
    return [(kind, a, address[i + 1] if i + 1 < n else None, address[i - 1] if i else None) for i, a in enumerate(address)]


def test_each_way_to_break_is_told(spark, scratch):
    whole, lost, twice = listing("a", "whole", 70), listing("a", "lost", 9), listing("a", "twice", 5)
    del lost[4]
    circle = listing("a", "circle", 33)
    circle[-1] = ("a", "circle/32", "circle/7", "circle/31")
    cut = listing("b", "whole", 4) + [("b", "whole/1", None, "whole/0")]      # the same addresses in another listing
    merged = listing("b", "m", 6) + [("b", "x/0", "m/3", None)]
    rows = whole + lost + twice + twice[2:3] + circle + cut + merged + [("b", None, "y", None), ("c", "z", "z", None)]
    got = chains(spark, rows, scratch)
    assert got == walked(rows)
    assert {r[1]: r[2] for r in got if r[0] == "a"} == {
        "whole/69": "complete", "lost/3": "missing", "lost/8": "headless", "twice/4": "repeated", "circle/10": "cycle"}
    assert {r[1]: r[2] for r in got if r[0] != "a"} == {"whole/3": "conflict", "m/5": "merged", None: "unaddressed", "z": "cycle"}


@pytest.mark.parametrize("seed", range(3))
def test_random_links(spark, scratch, seed):
    draw = random.Random(seed)
    rows = [("k", f"p{i}", draw.choice([None, f"p{draw.randrange(90)}", f"p{i + 1}", f"p{i + 1}"]), draw.choice([None, "p0"])) for i in range(80)]
    rows += [draw.choice(rows) for _ in range(5)] + [("k", f"p{i}", None, None) for i in range(3)]
    assert chains(spark, rows, scratch) == walked(rows)


def test_a_third_of_all_pages_lead_to_one(spark, scratch):
    rows = listing("k", "p", 40) + [("k", f"q{i}", "p/20", None) for i in range(500)]
    assert chains(spark, rows, scratch) == walked(rows)


def test_links_of_landed_files(spark, scratch):
    pages = [{"href": "u?1", "next": "u?2", "items": [{"id": "a"}]}, {"href": "u?2", "next": "", "previous": "u?1", "items": []}, {"items": None}]
    spark.createDataFrame([(json.dumps(p),) for p in pages], "value string").coalesce(1).write.text(f"{scratch}/playlists")
    links = read_links(spark, "bronze_playlists", f"{scratch}/playlists")
    assert [tuple(r) for r in page_chains(links, scratch).orderBy("n_pages").collect()] == [
        ("bronze_playlists", None, "unaddressed", 1, 0, 0, 0, 0, None), ("bronze_playlists", "u?2", "complete", 2, 0, 1, 0, 0, None)]
    text = spark.read.text(f"{scratch}/playlists").selectExpr("'x' AS kind", "value")
    assert parse_links(text, "value").where("kind = 'x'").count() == 3
    with pytest.raises(ValueError):
        read_links(spark, "bronze_tracks", scratch)


def test_no_pages(spark, scratch):
    assert chains(spark, [], scratch) == []


def test_requests_hold_what_is_missing(spark, scratch):
    keys = spark.createDataFrame([(f"t{i:04d}",) for i in range(400)] * 2 + [(None,), ("",)], "track_id string").repartition(6)
    known = spark.createDataFrame([(f"t{i:04d}",) for i in range(0, 400, 3)] + [(None,)], "track_id string")
    got = sorted(missing_requests(keys, known, "track_id", scratch).collect())
    want = [f"t{i:04d}" for i in range(400) if i % 3]
    assert [r.request for r in got] == list(range(6)) and [r.n_ids for r in got] == [50] * 5 + [16]
    assert ",".join(r.ids for r in got).split(",") == want
    assert missing_requests(known, known, "track_id", scratch).count() == 0
