"""Personal data: rules plus gradient-boosted selection of further candidates.

Everything per document is DataFrame functions; no Python runs on executors.

*Base rules* find e-mail addresses, IPv4 addresses, payment cards (Luhn) and
international phone numbers. Their patterns are written so that the regex
engine neither backtracks quadratically nor recurses on long runs (guards in
front, possessive loops); they match what the plain patterns match.

*Candidates.* Looser generators propose spans of the same kinds, overlapping
each other and the base spans: spelled-out addresses, numbers without a plus
sign, grouped digits, IPv6. Each has format features (length, digits, groups,
separators, check digit ...) and context features (neighbouring characters, a
telling word before it).

*Boosted trees* (Spark ML) are fitted on a bounded sample of the candidates that
checks can judge: about ``SAMPLE`` of every kind and label, with and without a
base span, so that rare forms are in it however large the table is. A base span of the kind confirms a candidate, and so do checks for the loose
forms: an address that is one once ``(at)`` and ``(dot)`` are put as signs, IPv6,
a check digit, a fitting number of digits with a plus or a telling word. What
fails them, and bare digits without a telling word, is negative; forms that no
check can tell (grouped digits without a telling word) are left out. The fitted
trees become one column expression, so scoring is a projection without a
shuffle. A threshold per kind is set from the judged candidates of all
documents but those the trees were fitted on, counted by score in one aggregate: the lowest score from which on at
least ``PRECISION`` of them are confirmed. Candidates that reach it and touch no
base span are added; base spans always stay. With no positives or no negatives
in the table there is no model and nothing is added.

Null text counts as empty: no spans. Very long texts with very many spans take
about n times the root of n steps for n spans (see ``folds``). Repeated rows are judged each; an empty
table gives an empty result. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.components import _written
from kiln.llm.folds import between, blocks_of, folded, let, parts_of

KINDS = ["email", "ip", "card", "phone"]
#: Candidates of each stratum that are drawn; the trees are fitted on half.
SAMPLE = 4000
PLACES = 1 << 30
PRECISION = 0.98
TREES = 8
DEPTH = 3
#: Characters before and after a candidate that its features may use.
LEFT, RIGHT = 24, 4

LOCAL = "A-Za-z0-9._%+-"
LABEL = "[A-Za-z0-9-]++"
BASE = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@{LABEL}(?:\.{LABEL})++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    # a sentence's end is no separator where dots are spelled out
    "email": rf"(?<![{LOCAL}])[{LOCAL}]++\x20?(?:@|\(at\)|\[at\])\x20?{LABEL}"
             rf"(?:(?:(?:\.|\x20\.\x20|\x20?(?:\(dot\)|\[dot\])\x20?){LABEL})++|(?:\x20?\.\x20?{LABEL})*+)",
    "ip": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|[0-9]{1,3}(?:\.[0-9]{1,3}){3,5}+)(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20./-]?[0-9]{4}){2}[\x20./-]?[0-9]{1,7}+(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])\+?(?:\([0-9]{1,4}\)|[0-9]{1,4}+)(?:[\x20.-]{0,2}(?:\([0-9]{1,4}\)|[0-9]{2,4}+)){2,5}+"
             r"(?![0-9A-Za-z])",
}
#: Cheap tests before the base rules and before the loose generators. Each is
#: implied by its pattern: a text without it cannot match.
BASE_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
NEEDS = {"email": r"@|[(\[]at[)\]]", "ip": r"[.:][0-9A-Fa-f]", "card": "[0-9]{4}", "phone": r"[0-9)][\x20.-]{0,2}[(0-9]"}
#: Words that announce a kind.
CUES = {"email": "mail|contact|write|address", "ip": r"\bip\b|host|server|addr", "card": "card|visa|credit|pay",
        "phone": r"\b(?:telephone|phone|tel|call|fax|mobile|cell)s?\b"}

OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
HIT = "array<struct<start:int,stop:int,value:string,left:string,right:string>>"
SPAN = "array<struct<start:int,kind:int,stop:int>>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _hits(text: Column, pattern: str, possible: Column) -> Column:
    """All matches with their code-point offsets and neighbourhoods: the
    pieces between matches give the offsets."""
    def zipped(found):
        n = F.size(found)
        return let(F.split(text, pattern, -1), lambda pieces: F.arrays_zip(
            found.alias("value"), F.slice(pieces, 1, n).alias("before"), F.slice(pieces, 2, n).alias("after")))

    def step(at, x):
        start = at + F.length(x["before"])
        stop = start + F.length(x["value"])
        return stop, F.struct(start.alias("start"), stop.alias("stop"), x["value"].alias("value"),
                              F.right(x["before"], F.lit(LEFT)).alias("left"), F.left(x["after"], F.lit(RIGHT)).alias("right"))

    each = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), zipped)
    hits = folded(each, F.lit(0), step, HIT[6:-1])["out"]
    return F.when(possible, hits).otherwise(F.array().cast(HIT))


def _near(spans: Column, body) -> Column:
    """``body(test)``; ``test(h, cond)`` tells whether one of the ``spans`` (by
    start) touches ``h`` and meets ``cond``. Blocks of spans are tried by their
    bounds first."""
    def bounded(blocks):
        return F.transform(blocks, lambda b: F.struct(
            F.array_min(F.transform(b, lambda s: s["start"])).alias("lo"),
            F.array_max(F.transform(b, lambda s: s["stop"])).alias("hi"), b.alias("spans")))

    def test(blocks):
        return lambda h, cond=None: F.exists(blocks, lambda b: (b["lo"] < h["stop"]) & (h["start"] < b["hi"]) & F.exists(
            b["spans"], lambda s: _touches(s, h) & (cond(s) if cond else F.lit(True))))

    return blocks_of(spans, lambda blocks: let(bounded(blocks), lambda made: body(test(made))))


def _valid(kind: str, value: Column) -> Column:
    """The check that a base match must pass."""
    n = F.length(_digits(value))
    return {"email": F.lit(True),
            "ip": value.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"),
            "card": n.between(14, 19) & F.call_function("luhn_check", _digits(value)),
            "phone": n.between(10, 15)}[kind]


def _features(kind: int, h: Column) -> Column:
    value, before, after = h["value"], F.lower(h["left"]), h["right"]
    digits = _digits(value)

    def count(pattern):
        return F.length(value) - F.length(F.regexp_replace(value, pattern, ""))

    flags = [F.lit(kind == k) for k in range(len(KINDS))]
    flags += [before.rlike(CUES[KINDS[kind]]), before.rlike(r"[0-9A-Za-z]$"), before.rlike(r"[0-9][\x20.-]$"),
              after.rlike("^[0-9A-Za-z]"), after.rlike(r"^[\x20.-][0-9]"), F.call_function("luhn_check", digits)]
    numbers = [F.length(value), F.length(digits), count("[A-Za-z]"), count(r"[\x20]"), count("-"), count(r"\."),
               count("[()]"), count("[@]"), count("[+]"), count(":"), count(r"\.|[(\[]dot[)\]]"), F.length(F.regexp_extract(value, r"([0-9]+)[^0-9]*$", 1)),
               F.length(F.regexp_extract(value, r"^[^0-9]*([0-9]+)", 1)),
               F.length(F.regexp_extract(value, r"([A-Za-z]+)$", 1))]
    return F.array(*[F.coalesce(x.cast("double"), F.lit(0.0)) for x in [*flags, *numbers]])


def _judged(kind: int, h: Column, near) -> Column:
    """1 for a candidate that the checks of its kind confirm, 0 for one they
    refute, null where no check can tell."""
    value, digits = h["value"], _digits(h["value"])
    n, luhn = F.length(digits), F.call_function("luhn_check", digits)
    if KINDS[kind] == "email":
        plain = F.regexp_replace(value, r"\x20?(?:@|\(at\)|\[at\])\x20?", "@")
        plain = F.regexp_replace(plain, r"\x20?(?:\(dot\)|\[dot\])\x20?", ".")
        tell = F.when(plain.rlike(rf"^[{LOCAL}]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{{2,}}$"), 1.0).when(~plain.contains(" "), 0.0)
    elif KINDS[kind] == "ip":
        six = value.rlike(r"^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$")
        tell = F.when(six | _valid("ip", value), 1.0).otherwise(0.0)
    elif KINDS[kind] == "card":
        tell = F.when(~luhn | ~n.between(13, 19), 0.0).when(n >= 14, 1.0)
    else:
        cued = value.startswith("+") | F.lower(h["left"]).rlike(CUES["phone"])
        tell = F.when(~n.between(10, 15), 0.0).when(cued, 1.0).when(n == F.length(value), 0.0)
    own, other = near(h, lambda b: b["kind"] == kind), near(h, lambda b: b["kind"] != kind)
    return F.when(own, 1.0).when(other, 0.0).otherwise(tell)


def _base(text: Column) -> Column:
    """Valid base spans of all kinds, by start, then kind."""
    parts = []
    for k, kind in enumerate(KINDS):
        good = F.filter(_hits(text, BASE[kind], text.rlike(BASE_NEEDS[kind])), lambda h: _valid(kind, h["value"]))
        parts.append(F.transform(good, lambda h: F.struct(h["start"].alias("start"), F.lit(k).alias("kind"),
                                                               h["stop"].alias("stop"))))
    return F.array_sort(F.concat(*parts))


def _candidates(text: Column, base: Column | None = None) -> Column:
    """Spans of the loose generators with their features; given the base
    spans, with the checks' ``label`` and whether a base span of the kind is
    ``found`` there too."""
    def candidate(k, h, near):
        out = [h["start"].alias("start"), F.lit(k).alias("kind"), h["stop"].alias("stop"), _features(k, h).alias("f")]
        if near is not None:
            out += [_judged(k, h, near).alias("label"), near(h, lambda b: b["kind"] == k).alias("found")]
        return F.struct(*out)

    def all_kinds(near=None):
        return F.concat(*[F.transform(_hits(text, LOOSE[kind], text.rlike(NEEDS[kind])), lambda h: candidate(k, h, near))
                          for k, kind in enumerate(KINDS)])

    return all_kinds() if base is None else _near(base, all_kinds)


def _touches(a: Column, b: Column) -> Column:
    return (a["start"] < b["stop"]) & (b["start"] < a["stop"])


def _margin(model, f: Column) -> Column:
    """The sum of the fitted trees as an expression over the features."""
    def tree(node) -> Column:
        if node.getClass().getSimpleName() == "LeafNode":
            return F.lit(float(node.prediction()))
        split = node.split()
        return F.when(F.element_at(f, int(split.featureIndex()) + 1) <= float(split.threshold()),
                      tree(node.leftChild())).otherwise(tree(node.rightChild()))

    java = model._java_obj
    return reduce(lambda a, b: a + b, [tree(t.rootNode()) * float(w) for t, w in zip(java.trees(), java.treeWeights())])


class Selector:
    """Fitted trees and calibrated thresholds; ``None`` model: nothing added."""

    def __init__(self, model=None, thresholds: dict[int, float] | None = None):
        self.model, self.thresholds = model, thresholds or {}

    def accepts(self, c: Column) -> Column:
        if self.model is None or not self.thresholds:
            return F.lit(False)
        least = reduce(lambda rest, kt: F.when(c["kind"] == kt[0], kt[1]).otherwise(rest),
                       self.thresholds.items(), F.lit(float("inf")))
        return _margin(self.model, c["f"]) >= least


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
        precision: float = PRECISION) -> Selector:
    """Fit trees on about ``sample`` judged candidates of each stratum (kind,
    label, base span or not) and set the thresholds from all of them."""
    src = docs.select(F.xxhash64(F.col(id_col).cast("string")).alias("h"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    based = src.select("h", "text", _base(F.col("text")).alias("base"))
    spans = based.select("h", _candidates(F.col("text"), F.col("base")).alias("cands"))
    # outer: else Spark looks for candidates once more, to drop texts without any
    rows = spans.select("h", F.posexplode_outer("cands").alias("pos", "c")).select(
        F.pmod(F.xxhash64("h", "pos"), F.lit(PLACES)).alias("place"), "c.kind", "c.f", "c.label", "c.found").filter("label is not null")
    table = _written(rows, "pii-candidates")
    strata = table.groupBy("kind", "label", "found").agg(F.count(F.lit(1)).alias("n")).collect()
    if len({r["label"] for r in strata}) < 2:
        return Selector()
    chosen = reduce(lambda a, b: a | b, [
        (F.col("kind") == r["kind"]) & (F.col("label") == r["label"]) & (F.col("found") == r["found"])
        & (F.col("place") < math.ceil(PLACES * min(1.0, sample / r["n"]))) for r in strata])
    # (repeated rows share their places and may bring more, hence the limit)
    fitted = chosen & (F.col("place") % 2 == 0)         # the other half, and all others, tell the precision
    train = table.filter(fitted).limit(2 * sample * len(strata)).select("label", array_to_vector("f").alias("features")).repartition(8)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, minInstancesPerNode=5).fit(train)
    score = F.round(_margin(model, F.col("f")), 2)
    bins = (table.filter(~fitted).groupBy("kind", score.alias("score"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")).collect())
    thresholds: dict[int, float] = {}
    for kind in range(len(KINDS)):
        n = good = 0.0
        for r in sorted((r for r in bins if r["kind"] == kind), key=lambda r: -r["score"]):
            n, good = n + r["n"], good + r["good"]
            if r["score"] > 0 and good >= precision * n:
                thresholds[kind] = r["score"] - 0.005
    return Selector(model, thresholds)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", selector: Selector | None = None,
         carry: list[str] | None = None) -> DataFrame:
    """Rows ``(doc, text, base, spans)``: ``doc`` a struct of the input columns
    (or those in ``carry``), ``base`` the base spans and ``spans`` base and
    added ones, each ``(start, kind, stop)`` by start, then kind (a number in
    ``KINDS``)."""
    selector = fit(docs, id_col, text_col) if selector is None else selector
    cols = [F.col(f"`{c}`") for c in (carry if carry is not None else docs.columns)]
    src = docs.select(F.struct(*cols).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    based = src.withColumn("base", _base(F.col("text")))
    if selector.model is None or not selector.thresholds:
        return based.withColumn("spans", F.col("base"))

    def span(c):
        return F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["stop"].alias("stop"))

    picked = based.withColumn("picked", F.transform(F.filter(_candidates(F.col("text")), selector.accepts), span))
    free = _near(F.col("base"), lambda near: F.filter(F.col("picked"), lambda c: ~near(c)))
    return picked.withColumn("spans", F.array_sort(F.concat("base", free))).drop("picked")


def labelled(spans: Column | str) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; spans that
    overlap become one, named by the first."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def rebuilt(parts):
        def step(at, s):
            piece = F.concat(between(parts, at, s["start"]), F.element_at(names, s["kind"] + 1))
            return F.greatest(at, s["stop"]), F.when(s["start"] >= at, piece).otherwise("")
        return let(folded(spans, F.lit(0), step, "string"), lambda done: F.concat(
            F.array_join(done["out"], ""), between(parts, done["at"], F.length(text))))

    return F.when(F.size(spans) == 0, text).otherwise(let(parts_of(text), rebuilt))
