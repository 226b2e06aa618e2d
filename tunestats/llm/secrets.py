"""Secret scanning: fixed patterns, and a battery of randomness tests.

Besides the patterns ``BASE``, every run of at least ``SHORTEST`` characters
that encodings of random bytes use is a candidate, and so are its parts of
that length between the signs that standard or URL-safe base64 or both do not
use, as a name or path may stand before a value. The encoding of each is
inferred (hex, base32, letters and digits, the two kinds of base64, or a
mixture; a run of digits alone is a number, not a candidate). Three tests ask whether it
looks like uniform random symbols of that alphabet: chi-squared uniformity,
the number of runs above and below the alphabet's middle, and the serial
correlation of neighbours. Three figures say how unlikely it is for ordinary
text: that all symbols fall into the alphabet, that so few symbols coincide,
and that the kind of character (lower, upper, digit, sign) changes so often.
A candidate is a finding if randomness is not rejected and its text p-value
passes the Benjamini-Hochberg procedure among all candidates, over all
documents, of its range of lengths.

Everything is DataFrame operations: one pass counts p-values by length and
bin (a table of bounded size, from which the thresholds are read), a second
marks the spans. Rows are never joined, so null and repeated ids do no harm.

Defined results: a null or empty text has no spans; spans of the battery may
overlap those of the patterns, which all stay; equal spans of two kinds are
both told; a finding of the battery inside another is not told again; the input's columns are kept and clashing output names refused with
``ValueError``; without candidates no threshold is set.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunestats.llm.spans import find, let, named, outermost, that_hold

#: Kind, pattern, and the condition on a match that counts.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    ("assign", ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8),
    ("access", "AKIA[A-Z0-9]{12,}+", None),
    ("hex", "[0-9a-f]{32,}+", None),
)
SHORTEST = 16
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}+"
#: Parts of a run: standard base64, URL-safe base64, and what both share or '+'.
PARTS = tuple(rf"[A-Za-z0-9{signs}]{{{SHORTEST},}}+={{0,2}}+" for signs in ("+/", "_-", "+"))
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "alnum": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    "mixed": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
#: The model of ordinary text: share of characters in each alphabet, chance
#: that two characters agree, and chance that the kind of character changes.
TEXT_SHARE = {"hex": 0.4, "base32": 0.1, "alnum": 0.98, "base64": 1.0, "base64url": 1.0, "mixed": 1.0}
TEXT_AGREE, TEXT_CUBES, TEXT_CHANGE = 0.065, 0.006, 0.06
STRATA = (24, 32, 48, 96)       # bounds between the ranges of lengths
RATE = 0.01                     # rate of false discoveries
RANDOM_LEVEL = 0.001            # level at which randomness is rejected
STEP = 10                       # bins for each power of ten of a p-value
LOWEST = -300                   # log10 p-values are not told apart below this


def log_tail(z: Column) -> Column:
    """Natural log of the upper tail of the normal distribution at z >= 0 (a
    bound that is exact at 0 and tight for large z)."""
    return -z * z / 2 + F.log(F.lit(math.sqrt(2 / math.pi)) / (z + F.sqrt(z * z + 8 / math.pi)))


def encoding(token: Column) -> Column:
    return (F.when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
            .when(token.rlike("^[A-Z2-7]+$"), "base32").when(token.rlike("^[A-Za-z0-9]+$"), "alnum")
            .when(token.rlike("^[A-Za-z0-9+/]+$"), "base64").when(token.rlike("^[A-Za-z0-9_-]+$"), "base64url").otherwise("mixed"))


def _by_encoding(enc: Column, values: dict) -> Column:
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(enc == name, F.lit(value)).otherwise(out)
    return out


def battery(token: Column) -> Column:
    """struct of the encoding, length, log p-value of the randomness tests
    (natural, the least of three, by Bonferroni) and log10 p-value under the
    model of text (likewise)."""
    body = F.regexp_replace(token, "=+$", "")

    # each step's values are bound once: inside a lambda an expression over the
    # whole token would be computed anew for every character
    def with_body(s: Column) -> Column:
        return let(F.struct(s.alias("s"), encoding(s).alias("enc")), with_encoding)

    def with_encoding(t: Column) -> Column:
        plain = F.when(t["enc"] == "hex", F.lower(t["s"])).otherwise(t["s"])
        return let(F.struct(t["s"].alias("s"), t["enc"].alias("enc"), plain.alias("plain"), F.length(t["s"]).cast("double").alias("n"),
                            _by_encoding(t["enc"], ALPHABETS).alias("alphabet"),
                            _by_encoding(t["enc"], {k: float(len(v)) for k, v in ALPHABETS.items()}).alias("k"),
                            F.array_remove(F.split(plain, ""), "").alias("chars")), with_chars)

    def with_chars(t: Column) -> Column:
        return let(F.struct(*(t[c].alias(c) for c in ("s", "enc", "plain", "n", "k", "chars")),
                            F.transform(t["chars"], lambda c: F.instr(t["alphabet"], c).cast("double")).alias("v")), with_symbols)

    def with_symbols(t: Column) -> Column:
        n, k, v = t["n"], t["k"], t["v"]
        squares = F.aggregate(F.array_distinct(t["chars"]), F.lit(0.0),
                              lambda a, c: a + F.pow(n - F.length(F.replace(t["plain"], c, F.lit(""))), F.lit(2)))
        upper = F.aggregate(v, F.lit(0.0), lambda a, x: a + F.when(x > (k + 1) / 2, 1.0).otherwise(0.0))
        mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / n
        pairs = F.zip_with(F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1),
                           lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(t["s"], "[a-z]", "a"), "[A-Z]", "b"), "[0-9]", "c")
        return let(F.struct(n.alias("n"), k.alias("k"), t["enc"].alias("enc"), squares.alias("squares"), upper.alias("n1"), mean.alias("mean"),
                            pairs.alias("pairs"), v.alias("v"),
                            # runs of characters of one kind, less one
                            (F.length(F.regexp_replace(kinds, r"(.)\1*+", "x")).cast("double") - 1).alias("changes")), with_sums)

    def with_sums(t: Column) -> Column:
        n, k, n1, mean = t["n"], t["k"], t["n1"], t["mean"]
        runs = F.aggregate(t["pairs"], F.lit(1.0),
                           lambda a, p: a + F.when((p["a"] > (k + 1) / 2) != (p["b"] > (k + 1) / 2), 1.0).otherwise(0.0))
        spread = F.aggregate(t["v"], F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
        serial = F.aggregate(t["pairs"], F.lit(0.0), lambda a, p: a + (p["a"] - mean) * (p["b"] - mean))
        # chi-squared, brought to a normal by the cube root
        df = k - 1
        chi = k / n * t["squares"] - n
        z_chi = (F.cbrt(F.greatest(chi, F.lit(0.0)) / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        both = 2 * n1 * (n - n1)
        r_mean, r_var = both / n + 1, both * (both - n) / (n * n * (n - 1))
        z_runs = F.when(r_var > 0, F.abs(runs - r_mean) / F.sqrt(r_var)).otherwise(F.lit(40.0))
        z_serial = F.when(spread > 0, F.abs(serial / spread) * F.sqrt(n)).otherwise(F.lit(40.0))
        random = math.log(3) + F.least(log_tail(F.greatest(z_chi, F.lit(0.0))), math.log(2) + log_tail(z_runs), math.log(2) + log_tail(z_serial))
        # how ordinary text would come by such a token
        share = n * _by_encoding(t["enc"], {e: math.log(q) for e, q in TEXT_SHARE.items()})
        agree = (t["squares"] - n) / (n * (n - 1))
        noise = F.sqrt(2 * TEXT_AGREE * (1 - TEXT_AGREE) / (n * (n - 1)) + 4 * (TEXT_CUBES - TEXT_AGREE ** 2) / n)
        few = log_tail(F.greatest((TEXT_AGREE - agree) / noise, F.lit(0.0)))
        c = F.greatest(F.least(t["changes"] / (n - 1), F.lit(1 - 1e-9)), F.lit(TEXT_CHANGE))
        often = -(n - 1) * (c * F.log(c / TEXT_CHANGE) + (1 - c) * F.log((1 - c) / (1 - TEXT_CHANGE)))
        text = (math.log(3) + F.least(share, few, often)) / math.log(10)
        return F.struct(t["enc"].alias("encoding"), n.cast("int").alias("length"), F.least(random, F.lit(0.0)).alias("log_random"),
                        F.greatest(F.least(text, F.lit(0.0)), F.lit(float(LOWEST))).alias("log10_text"))

    return let(body, with_body)


def stratum(length: Column) -> Column:
    out = F.lit(0)
    for bound in STRATA:
        out = out + F.when(length >= bound, 1).otherwise(0)
    return out


def candidates(text: Column) -> Column:
    """array of (start, end, match) of runs that an encoding could have made,
    and of their parts (with a letter, and at least two characters besides
    '=')."""

    def with_parts(s: Column) -> Column:
        glued = s["match"].rlike("[=/_-]")
        parts = F.concat(*(find(s["match"], pattern, glued) for pattern in PARTS))
        moved = F.transform(parts, lambda p: F.struct((s["start"] + p["start"]).alias("start"), (s["start"] + p["end"]).alias("end"), p["match"].alias("match")))
        return F.concat(F.array(s), moved)

    every = F.array_distinct(F.flatten(F.transform(find(text, CANDIDATE), with_parts)))
    return F.filter(every, lambda s: s["match"].rlike("[A-Za-z]") & (F.length(F.regexp_replace(s["match"], "=+$", "")) >= 2))


def thresholds(df: DataFrame, text_col: str = "text", rate: float = RATE) -> dict[int, float]:
    """log10 p-value below which a candidate is a discovery, by range of
    lengths, from the p-values of all candidates in ``df``."""
    tested = df.select(F.explode(candidates(F.coalesce(df[text_col], F.lit("")))).alias("c")).select(battery(F.col("c.match")).alias("b"))
    # at most 5 ranges times 3,001 bins: a table of bounded size
    counts = tested.groupBy(stratum(F.col("b.length")).alias("at"), F.ceil(F.col("b.log10_text") * STEP).cast("int").alias("bin")).count().collect()
    out: dict[int, float] = {}
    for at in {r["at"] for r in counts}:
        bins = sorted((r["bin"], r["count"]) for r in counts if r["at"] == at)
        total, below = sum(n for _, n in bins), 0
        for edge, n in bins:
            below += n
            if edge / STEP + math.log10(total) <= math.log10(rate) + math.log10(below):
                out[at] = edge / STEP
    return out


def base_spans(text: Column) -> Column:
    found = []
    for order, (kind, pattern, holds) in enumerate(BASE):
        spans = find(text, pattern)
        found.append(named(kind, order, spans if holds is None else that_hold(spans, holds)))
    return F.concat(*found)


def scan(df: DataFrame, text_col: str = "text", rate: float = RATE) -> DataFrame:
    """``df`` with ``base_spans`` and ``spans`` (arrays of start, order, end,
    kind, sorted): those of the patterns, and all with the battery's."""
    taken = {c.lower() for c in df.columns} & {"base_spans", "spans", "_found"}
    if taken:
        raise ValueError(f"the input already has the columns {sorted(taken)}")
    limit = thresholds(df, text_col, rate)
    text = F.coalesce(F.col(text_col), F.lit(""))

    def found(s: Column) -> Column:
        def passes(b: Column) -> Column:
            ok = F.lit(False)
            for at, bound in limit.items():
                ok = ok | ((stratum(b["length"]) == at) & (b["log10_text"] <= bound))
            return ok & (b["log_random"] >= math.log(RANDOM_LEVEL))
        return let(battery(s["match"]), passes)

    random = outermost(F.filter(candidates(text), found)) if limit else F.filter(find(text, CANDIDATE), lambda s: F.lit(False))
    marked = df.select("*", F.sort_array(base_spans(text)).alias("base_spans"), named("random", len(BASE), random).alias("_found"))
    return marked.select("*", F.sort_array(F.concat("base_spans", "_found")).alias("spans")).drop("_found")
