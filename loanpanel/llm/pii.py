"""Personal data: candidate spans scored by boosted trees, and redaction.  Column expressions only.

Fixed patterns with checks (Luhn, parts up to 255, numbers of digits) find the base spans, which always count.  Generators
with higher recall propose more, overlapping ones: spelled-out addresses, hexadecimal addresses, numbers without a
country code, digit groups with other separators or a failed check.  Each has a check of its own kind: the address that
'at' and 'dot' stand for, groups of a hexadecimal address, Luhn, the count of digits.  Boosted trees learn from one half of the texts which
formats and surroundings go with a passed check; what a kind's own check looks at is no feature of that kind.  The other half
gives the threshold of each kind, at which candidates pass their checks in ``PRECISION`` of the cases.  Of those that are no base span and
overlap none, a candidate at or above it is added, with its check passed or not: a number with a mistyped digit that looks and stands
like the others is found too.

Matches and their places come out of one split of the text, so a document is worked on in its own row: no joins, no
shuffle, and cost in proportion to the text.  The patterns are written so that a failed start is not tried again
within the same run of characters, which keeps them linear in long runs.

Cases: NULL and empty texts have no spans.  Texts are read whole, whatever their length.  Repeated rows and NULL ids are judged alike.  A
kind without a candidate in either half gets nothing added; an empty table gives no rows.  Extra columns are not read by
``find_personal`` and kept by ``redact``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanpanel.llm.common import written

KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    # The first part starts where its run of characters does, or where the last match ended.
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    # A run of digits that is as long as it gets and holds 14 to 19; others would be dropped anyway.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MORE = {
    "email": rf"(?<!{LOCAL}){LOCAL}{{1,64}}+\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?"
             r"[A-Za-z0-9-]{1,63}+(?:(?:\x20?\.(?:\x20(?=(?:com|org|net|edu|gov|info)\b))?|\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?)"
             r"[A-Za-z0-9-]{1,63}+){1,8}+",  # a full stop before a space ends the sentence
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}+(?::{1,2}+[0-9A-Fa-f]{1,4}+){3,7}+(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{3,6}+(?:[._/\x20-][0-9]{3,6}+){2,4}+(?![0-9])",
    "phone": r"(?<![0-9+(])\(?[0-9]{2,5}+\)?+[\x20./-]{1,2}+[0-9]{2,5}+(?:[\x20./-][0-9]{2,5}+){1,3}+(?![0-9])",
}
CUES = ("(?i)(mail|contact|write|phone|call|tel|mobile|fax|card|visa|account|address|host|server|correo|llam|tarjeta"
        "|adresse|rufen|karte|konto|courriel|appel|carte)")
NEAR = 24  # characters before a candidate that count as context
ROUNDS, RATE, PENALTY = 12, 0.3, 1.0
PRECISION = 0.98
NEVER = 1e6  # taken off the margins of a kind that no threshold has the precision for
CHUNK = 1024  # characters; texts are redacted in chunks so that no span is sought from the text's start


# ---- spans of one text ----

SPAN = "struct<start:bigint,end:bigint,value:string,before:string,after:string>"
STEP = 64  # running results are formed in blocks of so many items, and over the blocks


def nothing(item: str) -> Column:
    return F.expr(f"cast(array() as array<{item}>)")


def with_value(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, op, zero: Column) -> Column:
    """For each item of an array the result of ``op`` over the items before it.

    An aggregate copies its state at each step, so the results cannot be collected along one; items only look
    back to the start of their block, and blocks to the first one.
    """
    def blocks_of(v: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / STEP).cast("int")),
                           lambda j: F.aggregate(F.slice(v, j * STEP + 1, F.lit(STEP)), zero, op))
        starts = with_value(sums, lambda t: F.transform(t, lambda _, j: F.aggregate(F.slice(t, F.lit(1), j), zero, op)))

        def place(s: Column) -> Column:
            return F.transform(v, lambda _, i: F.aggregate(
                F.slice(v, (i - i % STEP) + 1, i % STEP), s[F.floor(i / STEP).cast("int")], op))
        return F.when(F.size(v) > 0, with_value(starts, place)).otherwise(F.slice(v, F.lit(1), F.lit(0)))

    return with_value(values, blocks_of)


def running_sum(values: Column) -> Column:
    return running(values, lambda a, x: a + x, F.lit(0).cast("long"))


def running_max(values: Column) -> Column:
    return running(values, lambda a, x: F.greatest(a, x), F.lit(0).cast("long"))


def matches(text: Column, pattern: str) -> Column:
    """All matches in order: ``start, end`` in code points, ``value``, and what stands ``before`` and ``after``.

    Splitting and extracting walk the same matches, so places are running sums of lengths.
    """
    def place(found: Column) -> Column:
        def spans(gaps: Column) -> Column:
            lengths = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda v, g: (
                F.length(v) + F.length(g)).cast("long"))

            def span(at: Column, i: Column) -> Column:
                start = at + F.length(gaps[i])
                return F.struct(start.alias("start"), (start + F.length(found[i])).alias("end"), found[i].alias("value"),
                                F.substring(gaps[i], -NEAR, NEAR).alias("before"),
                                F.substring(gaps[i + 1], 1, 1).alias("after"))
            return F.transform(running_sum(lengths), span)
        return F.when(F.size(found) > 0, with_value(F.split(text, pattern, -1), spans)).otherwise(nothing(SPAN))

    return with_value(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check; false for an empty one."""
    def add(acc: Column, k: Column) -> Column:
        digit = F.substring(number, -k, F.lit(1)).try_cast("int")
        twice = digit * 2
        return acc + F.when(k % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    total = F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add)
    return (F.length(number) > 0) & (F.coalesce(total % 10, F.lit(1)) == 0)


def parts_fit(value: Column) -> Column:
    """Dotted numbers of at most 255 each."""
    return F.forall(F.split(value, r"\."), lambda p: F.coalesce(
        F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))).try_cast("int"), F.lit(256)) <= 255)


def passes(kind: str, value: Column) -> Column:
    """The check of a base kind."""
    if kind == "ip":
        return parts_fit(value)
    if kind == "card":
        number = digits(value)
        return F.when(F.length(number).between(14, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    return F.lit(True)


ADDRESS = r"^[A-Za-z0-9_][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}$"
# Dates, and versions or addresses of four parts, that have as many digits as a phone number.
DATE = (r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$|"
        r"(?<![0-9])(?:(?:19|20)[0-9]{2}([./-])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([./-])[0-9]{1,2}\2(?:19|20)[0-9]{2})(?![0-9])")


def spelled_address(value: Column, before: Column) -> Column:
    """Whether 'at' and 'dot' stand for an address; a plain ' at ' before plain dots may name a site and needs a cue before it."""
    joined = F.regexp_replace(value, r"\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?", "@")
    joined = F.regexp_replace(joined, r"\x20?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)\x20?", ".")
    return joined.rlike(ADDRESS) & (value.rlike(r"[(\[]at[)\]]|[(\[\x20]dot[)\]\x20]") | before.rlike(CUES))


def hexadecimal_address(value: Column) -> Column:
    """Eight groups, or fewer with one gap."""
    groups = F.size(F.split(value, ":{1,2}"))
    return value.rlike("^[0-9A-Fa-f:]+$") & F.when(
        value.contains("::"), (groups <= 7) & ~value.rlike("::.*::")).otherwise(groups == 8)


def passes_more(kind: str, value: Column, before: Column) -> Column:
    """The check of a kind for a span of the further generators."""
    if kind == "email":
        return spelled_address(value, before)
    if kind == "ip":
        return hexadecimal_address(value)
    if kind == "phone":
        return passes(kind, value) & ~value.rlike(DATE)
    return passes(kind, value)


def hints(text: Column) -> dict[str, Column]:
    """What a text must hold for a match of the kind to be possible, base and more."""
    digit = text.rlike("[0-9]")
    return {"email": text.contains("@"), "ip": digit, "card": digit, "phone": text.contains("+"),
            "more email": text.rlike(r"(?:\(at\)|\[at\]|\x20at\x20)"), "more ip": text.rlike("[0-9A-Fa-f]:{1,2}[0-9A-Fa-f]"),
            "more card": digit, "more phone": digit}


def possible(text: Column) -> Column:
    """Whether any kind can have a match in a text."""
    return reduce(lambda a, b: a | b, hints(text).values())


def candidates(text: Column, prefix: str = "") -> Column:
    """All spans of the base patterns (``prefix`` empty) or the further generators, whether they pass or not."""
    out = []
    for number, kind in enumerate(KINDS):
        found = F.when(hints(text)[prefix + kind], matches(text, (MORE if prefix else BASE)[kind]))
        out.append(F.transform(F.coalesce(found, nothing(SPAN)), _named(number, kind, not prefix)))
    return F.concat(*out)


def _named(number: int, kind: str, is_base: bool):
    """Match to candidate: its kind, whether it passes its check, and whether it is a base span."""
    def named(m: Column) -> Column:
        good = passes(kind, m["value"]) if is_base else passes_more(kind, m["value"], m["before"])
        return F.struct(
            m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end"),
            (good if is_base else F.lit(False)).alias("base"), good.alias("good"), m["value"].alias("value"),
            m["before"].alias("before"), m["after"].alias("after"))
    return named


def _clear_of(base: Column, more: Column) -> Column:
    """The items of ``more`` that overlap no item of ``base``, in order."""
    def flagged(spans: Column, extra: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(extra).alias("extra"), s.alias("span")))

    def choose(spans: Column) -> Column:
        far = F.lit(1 << 62)
        reach = running_max(F.transform(spans, lambda s: F.when(s["extra"] == 0, s["span"]["end"]).otherwise(F.lit(0).cast("long"))))
        begins = F.reverse(F.transform(spans, lambda s: F.when(s["extra"] == 0, s["start"]).otherwise(far)))
        following = F.reverse(running(begins, lambda a, x: F.least(a, x), far))
        kept = F.filter(F.arrays_zip(spans.alias("s"), reach.alias("reach"), following.alias("next")), lambda z: (
            z["s"]["extra"] == 1) & (z["s"]["start"] >= z["reach"]) & (z["s"]["span"]["end"] <= z["next"]))
        return F.transform(kept, lambda z: z["s"]["span"])

    both = F.array_sort(F.concat(flagged(base, 0), flagged(more, 1)))
    return F.when((F.size(more) > 0) & (F.size(base) > 0), with_value(both, choose)).otherwise(more)


def _with_candidates(docs: DataFrame) -> DataFrame:
    """The documents with ``_pii_base``, candidates that are base spans, and ``_pii_rest``, those that overlap none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumn("_pii_all", candidates(text)).withColumn("_pii_further", candidates(text, "more "))
    out = out.withColumn("_pii_base", F.filter("_pii_all", lambda c: c["base"])).withColumn(
        "_pii_rest", F.concat(F.filter("_pii_all", lambda c: ~c["base"]), "_pii_further"))
    return out.withColumn("_pii_rest", _clear_of(F.col("_pii_base"), F.col("_pii_rest"))).drop("_pii_all", "_pii_further")


# ---- features, boosted trees, threshold ----

FEATURES = ("kind", "digits", "letters", "separators", "luhn", "parts", "plus", "at", "left", "right", "cue", "date", "mark")


# What the check of a kind looks at, or follows from: no cut of its trees is made there.
CHECKED = {"email": ("kind", "at"), "ip": ("kind", "parts"), "card": ("kind", "luhn"), "phone": ("kind", "digits", "date")}


def features(c: Column) -> list[Column]:
    """Small whole numbers that describe the format and the context of a candidate."""
    value, number = c["value"], digits(c["value"])
    letters = F.regexp_replace(value, "[^A-Za-z]", "")

    def beside(char: Column) -> Column:
        return (F.when(F.coalesce(char, F.lit("")).rlike(r"^[A-Za-z0-9]"), 2)
                .when(F.coalesce(char, F.lit("")).rlike(r"^[^\x20\x09-\x0D]"), 1).otherwise(0))

    return [c["kind"], F.least(F.length(number), F.lit(20)), F.least(F.floor(F.length(letters) / 2), F.lit(15)),
            F.least(F.length(value) - F.length(number) - F.length(letters), F.lit(9)),
            F.when(F.length(number).between(12, 19) & luhn(number), 1).otherwise(0),
            F.when(value.rlike(r"^[0-9]+(\.[0-9]+){3}$") & parts_fit(value), 1).when(hexadecimal_address(value), 2).otherwise(0),
            F.when(value.startswith("+"), 1).otherwise(0),
            F.when(value.contains("@"), 1).when(spelled_address(value, c["before"]), 2).otherwise(0),
            beside(F.substring(c["before"], -1, 1)), beside(c["after"]),
            F.when(c["before"].rlike(CUES), 1).otherwise(0), F.when(value.rlike(DATE), 1).otherwise(0),
            F.when(value.contains("@"), 1).when(value.contains(":"), 2).otherwise(0)]


def leaf(tree: list[tuple], x: list[Column]) -> Column:
    """Value of a tree ``(feature, cut, (feature, cut, low, high), (feature, cut, low, high))``."""
    def branch(node: tuple) -> Column:
        feature, cut, low, high = node
        return F.when(x[feature] <= cut, F.lit(low)).otherwise(F.lit(high))
    feature, cut, low, high = tree
    return F.when(x[feature] <= cut, branch(low)).otherwise(branch(high))


def margin(trees: list[tuple], x: list[Column]) -> Column:
    """Sum of the trees; one with a fifth item counts for that kind only."""
    def total(own: list[tuple]) -> Column:
        return reduce(lambda a, b: a + b, [leaf(t[:4], x) for t in own], F.lit(0.0))
    by_kind = [(k, [t for t in trees if t[4:] == (k,)]) for k in range(len(KINDS))]
    return reduce(lambda a, b: a + b, [F.when(x[0] == k, total(own)).otherwise(0.0) for k, own in by_kind if own],
                  total([t for t in trees if not t[4:]]))


def _likely(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of the texts that hold a candidate's characters."""
    return docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"), "doc_id").where(possible(F.col("text")))


def described(docs: DataFrame) -> DataFrame:
    """Written ``half, f0.., n, good``: how many candidates of all texts have the same features, and how many of them pass.

    One scan of the texts.  ``half`` follows from a hash of the text, so that copies are in the same one.
    """
    half = F.pmod(F.xxhash64("text", F.lit("half")), F.lit(2)).cast("int")
    each = _with_candidates(_likely(docs)).select(half.alias("half"), F.explode(F.concat("_pii_base", "_pii_rest")).alias("c"))
    names = [f"f{k}" for k in range(len(FEATURES))]
    values = [f.cast("int").alias(n) for n, f in zip(names, features(F.col("c")))]
    return written(each.select("half", F.col("c.good").cast("int").alias("good"), *values).groupBy("half", *names).agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good")), "pii-candidates")


def scored(counted: DataFrame, trees: list[tuple]) -> DataFrame:
    """How many candidates have each ``kind`` and ``margin``, and how many of them pass."""
    x = [F.col(f"f{k}") for k in range(len(FEATURES))]
    return counted.groupBy(F.col("f0").alias("kind"), F.round(margin(trees, x), 3).alias("margin")).agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"))


def fit(docs: DataFrame) -> tuple[list[tuple], float]:
    """Boosted trees of depth two and the threshold of their margin.

    The trees learn from one half of all texts, and the threshold is calibrated on the other.  Equal candidates are counted
    together, by their features.  Every kind has trees of its own, in which passing and failing candidates have equal weight, so that rare
    kinds are told apart as well.  For each level of a tree Spark sums gradients by (branch, feature, value), a few hundred rows, and the driver picks
    the cuts.  The last tree takes the threshold of its kind from each margin, so that one threshold, 0, holds for all kinds.
    """
    counted = described(docs)
    train = counted.where("half = 0")
    names = [f"f{k}" for k in range(len(FEATURES))]
    x = [F.col(c) for c in names]
    sizes = train.groupBy("f0").agg(F.sum("good").alias("good"), F.sum(F.col("n") - F.col("good")).alias("bad")).collect()
    if not sizes:
        return [], math.inf
    share = sum(r["good"] + r["bad"] for r in sizes) / (2 * len(KINDS))

    def weighted(outcome: str) -> Column:
        return reduce(lambda a, r: F.when(F.col("f0") == r["f0"], share / max(r[outcome], 1)).otherwise(a), sizes, F.lit(0.0))
    good, bad = F.col("good") * weighted("good"), (F.col("n") - F.col("good")) * weighted("bad")
    train = train.select(*names, (good + bad).alias("n"), good.alias("good"))
    trees: list[tuple] = []
    for _ in range(ROUNDS):
        p = 1 / (1 + F.exp(-margin(trees, x)))
        graded = train.select(*names, (F.col("good") - F.col("n") * p).alias("g"), (F.col("n") * p * (1 - p)).alias("h"))
        root = _best_cuts(graded.withColumn("side", F.col("f0")), names, lambda side: side)
        if not root:
            break
        high = reduce(lambda a, k: F.when(F.col("f0") == k, (x[root[k][0]] > root[k][1]).cast("int")).otherwise(a), root, F.lit(0))
        sides = _best_cuts(graded.withColumn("side", F.col("f0") * 2 + high), names, lambda side: side // 2)
        for kind, (feature, cut, *whole) in root.items():
            branches = [sides.get(2 * kind + k, (0, math.inf, whole[k], whole[k])) for k in (0, 1)]
            trees.append((feature, cut, *branches, kind))
    return calibrated(trees, scored(counted.where("half = 1"), trees))


def calibrated(trees: list[tuple], counts: DataFrame) -> tuple[list[tuple], float]:
    """The trees and one that takes off the kind's threshold, the lowest that has the precision.

    ``counts`` counts candidates by ``kind`` and ``margin``, at most one row per combination of leaves.  A kind without any gets
    none added; one whose candidates all pass has no trees and margin 0.
    """
    rows = sorted(((r["kind"], r["margin"], r["n"], r["good"]) for r in counts.collect()), key=lambda r: -r[1])
    level = []
    for kind in range(len(KINDS)):
        own = [r[1:] for r in rows if r[0] == kind]
        threshold, n, good = math.inf, 0, 0
        for at, row_n, row_good in own:
            n, good = n + row_n, good + row_good
            if good >= PRECISION * n:
                threshold = at
        level.append(-min(threshold, NEVER))
    shift = (0, 1, (0, 0, level[0], level[1]), (0, 2, level[2], level[3]))
    return [*trees, shift], (0.0 if max(level) > -NEVER else math.inf)


def _best_cuts(graded: DataFrame, names: list[str], kind_of) -> dict[int, tuple]:
    """Per side the (feature, cut, value below, value above) that lowers the loss most; ``kind_of(side)`` is the side's kind."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("f"), F.col(c).alias("v")) for k, c in enumerate(names)]))
    sums = graded.select("side", "g", "h", pairs.alias("p")).groupBy("side", "p.f", "p.v").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
    best: dict[int, tuple] = {}
    gains: dict[int, float] = {}
    for side in sorted({r["side"] for r in sums}):
        checked = CHECKED[KINDS[kind_of(side)]]
        for f in (k for k, name in enumerate(FEATURES) if name not in checked):
            rows = sorted((r["v"], r["g"], r["h"]) for r in sums if r["side"] == side and r["f"] == f)
            all_g, all_h = sum(r[1] for r in rows), sum(r[2] for r in rows)
            g = h = 0.0
            for v, row_g, row_h in rows[:-1]:
                g, h = g + row_g, h + row_h
                gain = g * g / (h + PENALTY) + (all_g - g) ** 2 / (all_h - h + PENALTY) - all_g**2 / (all_h + PENALTY)
                if gain > gains.get(side, 1e-6):
                    gains[side] = gain
                    best[side] = (f, v, round(RATE * g / (h + PENALTY), 3), round(RATE * (all_g - g) / (all_h - h + PENALTY), 3))
    return best


# ---- results ----

BRIEF = "struct<start:bigint,kind:int,end:bigint>"


def _brief(spans: Column) -> Column:
    return F.array_sort(F.transform(spans, lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))


def _added(text: Column, unchecked: Column, trees: list[tuple], threshold: float) -> Column:
    """Candidates that pass no check and score at or above the threshold."""
    if not trees or math.isinf(threshold):
        return nothing(BRIEF)
    rest = F.concat(F.filter(unchecked, lambda c: ~c["base"]), candidates(text, "more "))

    def scores(c: Column) -> Column:
        return with_value(F.array(*[f.cast("int") for f in features(c)]),
                          lambda x: F.round(margin(trees, [x[k] for k in range(len(FEATURES))]), 3) >= threshold)
    return _brief(F.filter(rest, scores))


def _united(base: Column, more: Column) -> Column:
    """Base spans, and those of ``more`` that overlap no base span and no span of either that starts before them."""
    def flagged(spans: Column, extra: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(extra).alias("extra"),
                                                     s["kind"].alias("kind"), s["end"].alias("end")))

    def choose(spans: Column) -> Column:
        far = F.lit(1 << 62)
        reach = running_max(F.transform(spans, lambda s: s["end"]))
        begins = F.reverse(F.transform(spans, lambda s: F.when(s["extra"] == 0, s["start"]).otherwise(far)))
        following = F.reverse(running(begins, lambda a, x: F.least(a, x), far))
        kept = F.filter(F.arrays_zip(spans.alias("s"), reach.alias("reach"), following.alias("next")), lambda z: (
            z["s"]["extra"] == 0) | ((z["s"]["start"] >= z["reach"]) & (z["s"]["end"] <= z["next"])))
        return _brief(F.transform(kept, lambda z: z["s"]))

    both = F.array_sort(F.concat(flagged(base, 0), flagged(more, 1)))
    return F.when(F.size(more) > 0, with_value(both, choose)).otherwise(base)


def as_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_spans(docs: DataFrame, model: tuple[list[tuple], float]) -> DataFrame:
    """The documents with the columns ``_pii_base`` and ``_pii_spans``.

    One projection after the other, so that each result is computed once; texts without
    a candidate's characters skip the work.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    likely = possible(text)
    out = docs.withColumn("_pii_all", F.when(likely, candidates(text)))
    out = out.withColumn("_pii_base", F.coalesce(_brief(F.filter("_pii_all", lambda c: c["base"])), nothing(BRIEF)))
    out = out.withColumn("_pii_more", F.coalesce(F.when(likely, _added(text, F.col("_pii_all"), *model)), nothing(BRIEF)))
    return out.withColumn("_pii_spans", _united(F.col("_pii_base"), F.col("_pii_more"))).drop("_pii_all", "_pii_more")


def find_personal(docs: DataFrame, model: tuple[list[tuple], float] | None = None) -> DataFrame:
    """``doc_id``, ``base`` spans and all ``spans`` of every document, as arrays of (start, kind, end)."""
    found = with_spans(docs.select("doc_id", "text"), model or fit(docs))
    return found.select("doc_id", F.col("_pii_base").alias("base"), F.col("_pii_spans").alias("spans"))


def redact(docs: DataFrame, model: tuple[list[tuple], float] | None = None) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; ``n_chars`` follows the new text."""
    text, spans = F.col("text"), F.col("_pii_spans")
    out = with_spans(docs, model or fit(docs)).withColumn(
        "text", F.when(F.size(spans) > 0, _without(text, spans)).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def _without(text: Column, spans: Column) -> Column:
    """The text around the merged spans, with a mark for each."""
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def build(chunks: Column) -> Column:
        def cut(start: Column, end: Column) -> Column:
            first, last = F.floor(start / CHUNK).cast("int"), F.floor((end - 1) / CHUNK).cast("int")
            from_first = (start % CHUNK + 1).cast("int")
            head = F.substring(chunks[first], from_first, F.lit(CHUNK))
            tail = F.substring(chunks[last], F.lit(1), ((end - 1) % CHUNK + 1).cast("int"))
            middle = F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
            one = F.substring(chunks[first], from_first, (end - start).cast("int"))
            return F.when(end <= start, "").when(first == last, one).otherwise(F.concat(head, middle, tail))

        size = F.length(text).cast("long")
        ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
        marked = F.concat(spans, F.array(F.struct(size.alias("start"), F.lit(None).cast("int").alias("kind"), size.alias("end"))))
        reach = F.slice(running_max(F.concat(ends, F.array(size))), F.lit(2), F.size(spans) + 1)
        return F.array_join(F.zip_with(marked, reach, lambda s, at: F.when(s["start"] >= at, F.concat(
            cut(at, s["start"]), F.coalesce(F.get(marks, s["kind"]), F.lit(""))))), "")

    return with_value(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), build)
