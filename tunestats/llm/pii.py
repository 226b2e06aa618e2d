"""Personal data: fixed patterns, and boosted trees over wide proposals.

Besides the validated patterns ``BASE``, high-recall generators propose spans
that may overlap. Trees are boosted (``pyspark.ml``) on all proposals: a proposal is a positive if its own text passes a base pattern's
check or that of its generator's other kinds (an address with (at) and (dot)
put back, a national telephone number right after a word that announces one,
an IBAN's remainder by 97), and the features are its format (length, digits,
signs, groups) and its context (the characters around it, key words before
it), never the check itself. On a third of them that the trees have not seen, each generator
gets the lowest threshold at which its selections are right often enough. The
fitted trees become one expression, and everything that runs over all rows is
DataFrame operations.

Bounds: the fit counts all proposals by their features and label, and the trees
are boosted on the counted rows with their counts as weights, so that equal
proposals are one row of it; these rows stay on the executors. Only a caller
who gives ``fit_rows`` gets a fit on about so many proposals, and as many more
at most, so that each generator has its share. The thresholds are read from a
table of at most 5 x 21 counts.

Defined results: a null or empty text has no spans; base spans all stay, and
proposals inside one of them are not told again; equal proposals of two
generators are both told; without proposals of both labels there are no trees
and only base spans; the input's columns are kept and clashing output names
refused with ``ValueError``; null and repeated ids do no harm, as rows are
never joined.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunestats.llm.sampling import SPACE
from tunestats.llm.spans import find, named, not_inside, that_hold

#: The base patterns. A match can only begin where a run of its
#: first characters begins or the last match ended, and gives nothing back, so
#: long runs cost one pass and no recursion; the matches are those of the
#: plain patterns.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

GENERATORS = {
    "contact": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++\x20?(?:@|[(\[{]at[)\]}])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[(\[{]dot[)\]}])\x20?[A-Za-z0-9-]++)*+",
    "number": r"\+?\(?[0-9](?:[\x20()./-]{0,3}[0-9]){6,}+",
    "digits": r"(?<![0-9])[0-9]{13,19}+(?![0-9])",
    "dotted": r"(?<![0-9.])[0-9]{1,4}+(?:\.[0-9]{1,4}+){3,}+(?![0-9])",
    "code": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
KEYWORDS = r"(?i)(mail|phone|tel|call|fax|mobil|card|visa|iban|account|ssn|passport|address|contact|server|host|login)"
FEATURES = ("length", "digits", "letters", "signs", "plus", "brackets", "dots", "at", "before", "after", "keyword",
            "groups", "longest", "distinct", "domain", "lead", "generator")
CONTEXT = 24
TREES, DEPTH = 10, 3
PRECISION = 0.9
SUPPORT = 10                 # right selections that a threshold must rest on
BINS = 20


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The check over up to 19 digits; zeros in front change nothing."""
    padded = F.lpad(digits, 20, "0")
    total = F.lit(0)
    for i in range(1, 21):
        c = F.substring(padded, i, 1)
        total = total + F.coalesce((F.translate(c, "0123456789", "0246813579") if i % 2 else c).try_cast("int"), F.lit(0))
    return total % 10 == 0


def ip_holds(match: Column) -> Column:
    # a part is at most 255 if it has at most three digits after its zeros, and that value
    return F.forall(F.split(match, r"\."), lambda p: F.coalesce(
        F.when(F.length(F.ltrim(p, F.lit("0"))) <= 3, F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))).try_cast("int") <= 255), F.lit(False)))


def card_holds(match: Column) -> Column:
    d = digits_of(match)
    return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False))


def phone_holds(match: Column) -> Column:
    return F.length(digits_of(match)).between(9, 15)


def base_spans(text: Column) -> Column:
    """Valid spans of the base patterns, by kind, then start."""
    return F.concat(
        named("email", 0, find(text, EMAIL, F.contains(text, F.lit("@")))),
        named("ip", 1, that_hold(find(text, IP), ip_holds)),
        named("card", 2, that_hold(find(text, CARD), card_holds)),
        named("phone", 3, that_hold(find(text, PHONE, F.contains(text, F.lit("+"))), phone_holds)))


def proposals(text: Column) -> Column:
    """array of struct(start, end, match, before, after, generator) of all
    generators; before and after are what lies around the match."""
    found = []
    for k, (name, pattern) in enumerate(GENERATORS.items()):
        guard = text.rlike(r"@|[(\[{]at[)\]}]") if name == "contact" else None
        found.append(_marked(find(text, pattern, guard, CONTEXT), k))
    return F.concat(*found)


def _marked(spans: Column, k: int) -> Column:
    return F.transform(spans, lambda s: F.struct(*(s[c].alias(c) for c in ("start", "end", "match", "before", "after")),
                                                 F.lit(float(k)).alias("generator")))


def _kind_of(char: Column) -> Column:
    return (F.when(F.length(char) == 0, 0.0).when(char.rlike(r"^\s"), 1.0).when(char.rlike(r"^\p{L}"), 2.0)
            .when(char.rlike("^[0-9]"), 3.0).otherwise(4.0))


def features(s: Column) -> Column:
    """struct of a proposal and its features, all double."""
    m, d, before, after = s["match"], digits_of(s["match"]), s["before"], s["after"]
    groups = F.filter(F.split(m, "[^0-9]+"), lambda g: F.length(g) > 0)
    value = {
        "length": F.length(m), "digits": F.length(d), "letters": F.length(F.regexp_replace(m, "[^A-Za-z]", "")),
        "signs": F.length(F.regexp_replace(m, "[A-Za-z0-9]", "")), "plus": F.startswith(m, F.lit("+")), "brackets": m.rlike("[()]"),
        "dots": F.length(F.regexp_replace(m, "[^.]", "")), "at": F.contains(m, F.lit("@")),
        "before": _kind_of(F.substring(before, -1, 1)), "after": _kind_of(after), "keyword": before.rlike(KEYWORDS),
        "groups": F.size(groups), "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "distinct": F.size(F.array_distinct(F.split(d, ""))), "domain": m.rlike(r"\.[A-Za-z]{2,}$"),
        "lead": F.coalesce(F.substring(d, 1, 1).try_cast("int"), F.lit(-1)), "generator": s["generator"]}
    return F.struct(s["start"].alias("start"), s["end"].alias("end"), m.alias("match"),
                    *(value[f].cast("double").alias(f) for f in FEATURES))


def is_valid(match: Column) -> Column:
    """Does the whole of a proposal pass a base pattern's check?"""
    return (match.rlike(r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$")
            | (match.rlike(r"^[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++$") & ip_holds(match))
            | (match.rlike(r"^[0-9](?:[\x20-]?[0-9]){12,}+$") & card_holds(match))
            | (match.rlike(r"^\+[0-9][\x20().0-9-]+[0-9]$") & phone_holds(match)))


ANNOUNCED = r"(?i)(?<![A-Za-z])(?:(?:tele)?phone|tel|telefon|call|fax|mobile?|cell)(?:\x20(?:no|nr|number|me|us|at|is|on))*[\x20.:=#]{0,3}$"
NATIONAL = r"^(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[\x20./-]{0,3}[0-9]{2,8}){1,5}$"
DATE = r"^(?:(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2})$"


def contact_holds(match: Column) -> Column:
    """An address, with its signs put back, in a domain of letters."""
    plain = F.regexp_replace(F.regexp_replace(match, r"\x20?[(\[{]at[)\]}]\x20?", "@"), r"\x20?[(\[{]dot[)\]}]\x20?", ".")
    return F.regexp_replace(plain, r"\x20?([@.])\x20?", "$1").rlike(r"^[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}$")


def national_holds(match: Column, before: Column) -> Column:
    return before.rlike(ANNOUNCED) & match.rlike(NATIONAL) & ~match.rlike(DATE) & F.length(digits_of(match)).between(7, 15)


def iban_holds(match: Column) -> Column:
    """At least 15 signs; with the first four at the end, and letters as 10 to
    35, the remainder by 97 is 1."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    rest = F.aggregate(F.array_remove(F.split(turned, ""), ""), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))
    return (F.length(plain) >= 15) & (rest == 1)


def is_right(s: Column) -> Column:
    """The label of a proposal, by the checks of its generator's kinds."""
    m, own = s["match"], {name: s["generator"] == float(k) for k, name in enumerate(GENERATORS)}
    before = s["before"]
    return F.when(is_valid(m), True).when(own["contact"], contact_holds(m)).when(own["number"], national_holds(m, before)) \
        .when(own["code"], iban_holds(m)).otherwise(False)


def trees_column(model: GBTClassificationModel, value) -> Column:
    """The boosted trees as one expression: probability of a positive.
    ``value`` gives the column of a feature's name."""

    def node(n) -> Column:
        if n.subtreeDepth() == 0:
            return F.lit(float(n.prediction()))
        split = n.split()
        return F.when(value(FEATURES[split.featureIndex()]) <= float(split.threshold()), node(n.leftChild())).otherwise(node(n.rightChild()))

    margin = F.lit(0.0)
    for weight, tree in zip(model.treeWeights, model.trees):
        margin = margin + float(weight) * node(tree._java_obj.rootNode())
    return 1 / (1 + F.exp(-2 * margin))


class PiiModel:
    """Fitted trees with a threshold for each generator that has one."""

    def __init__(self, trees: GBTClassificationModel | None, limits: dict[int, float]):
        self.trees, self.limits = trees, limits

    def selects(self, f: Column) -> Column:
        p = trees_column(self.trees, lambda name: f[name])
        ok = F.lit(False)
        for k, limit in self.limits.items():
            ok = F.when(f["generator"] == float(k), p >= limit).otherwise(ok)
        return ok


def _share(proposed: DataFrame, fit_rows: int) -> DataFrame:
    """Around ``fit_rows`` proposals by their hash, more of rare generators."""
    totals = {int(r["generator"]): r["count"] for r in proposed.groupBy(F.col("s.generator").alias("generator")).count().collect()}
    place, bound = F.pmod(F.xxhash64("t", "k"), F.lit(SPACE)), F.lit(0)
    for k, n in totals.items():
        rate = max(fit_rows / sum(totals.values()), fit_rows / len(GENERATORS) / n)
        bound = F.when(F.col("s.generator") == float(k), min(SPACE, int(SPACE * rate) + 1)).otherwise(bound)
    return proposed.where(place < bound)


def fit(df: DataFrame, text_col: str = "text", fit_rows: int | None = None) -> PiiModel:
    """Boost trees on all proposals in ``df`` (``fit_rows``: on about so many)."""
    text = F.coalesce(df[text_col], F.lit(""))
    proposed = df.select(text.alias("t"), F.posexplode(proposals(text)).alias("k", "s"))
    if fit_rows is not None:
        proposed = _share(proposed, fit_rows)
    rows = proposed.select(features(F.col("s")).alias("f"), F.pmod(F.xxhash64("s.match"), F.lit(3)).alias("part"),
                           is_right(F.col("s")).cast("double").alias("label"))
    keys = [*FEATURES, "part", "label"]
    rows = rows.select("f.*", "part", "label").groupBy(*keys).agg(F.count("*").cast("double").alias("weight"))
    # in an order, as sums of doubles depend on it
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows.sortWithinPartitions(*keys)).persist()
    try:
        kinds = {(r["part"] == 0, r["label"]) for r in rows.select("part", "label").distinct().collect()}
        if not {(False, 0.0), (False, 1.0)} <= kinds:
            return PiiModel(None, {})
        trees = GBTClassifier(featuresCol="x", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=7,
                              checkpointInterval=-1, subsamplingRate=1.0).fit(rows.where("part > 0"))
        scored = rows.where("part = 0").select("generator", "label", "weight", F.floor(trees_column(trees, F.col) * BINS).cast("int").alias("bin"))
        counts = scored.groupBy("generator", "bin").agg(
            F.sum(F.col("label") * F.col("weight")).alias("right"), F.sum("weight").alias("n")).collect()
    finally:
        rows.unpersist()
    limits = {}
    for k in range(len(GENERATORS)):
        right = n = 0
        for r in sorted((r for r in counts if r["generator"] == k), key=lambda r: -r["bin"]):
            right, n = right + r["right"], n + r["n"]
            if right >= SUPPORT and right >= PRECISION * n:
                limits[k] = r["bin"] / BINS
    return PiiModel(trees, limits)


def scan(df: DataFrame, model: PiiModel, text_col: str = "text") -> DataFrame:
    """``df`` with ``base_spans`` and ``spans`` (arrays of struct of start,
    order, end, kind; by kind, then start): the patterns' spans, and all with
    the selected proposals."""
    taken = {c.lower() for c in df.columns} & {"base_spans", "spans", "_proposed"}
    if taken:
        raise ValueError(f"the input already has the columns {sorted(taken)}")
    text = F.coalesce(F.col(text_col), F.lit(""))
    step = df.select("*", base_spans(text).alias("base_spans"))
    if not model.limits:
        return step.select("*", F.col("base_spans").alias("spans"))
    kind = "struct<start:int,end:int,match:string," + ",".join(f"{f}:double" for f in FEATURES) + ">"
    step = step.select("*", F.transform(proposals(text), features).alias("_proposed"))
    fresh = not_inside(F.filter("_proposed", model.selects), F.col("base_spans"), kind)
    names = F.array(*map(F.lit, GENERATORS))
    more = F.sort_array(F.transform(fresh, lambda f: F.struct(
        (f["generator"].cast("int") + 4).alias("order"), f["start"].alias("start"), f["end"].alias("end"),
        F.get(names, f["generator"].cast("int")).alias("kind"))))
    more = F.transform(more, lambda f: F.struct(*(f[c].alias(c) for c in ("start", "order", "end", "kind"))))
    return step.select("*", F.concat("base_spans", more).alias("spans")).drop("_proposed")
