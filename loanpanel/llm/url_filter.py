"""URL filters: path rules first, then exact membership of the host by a cascade of Bloom filters.

The corpus gives the complete universe of hosts.  Level 1 holds the listed hosts; level 2 the unlisted hosts that
level 1 wrongly lets through; level 3 the listed ones that level 2 lets through, and so on until a level has no
false positives.  The first level that a host of the universe misses decides, without error.  The filters are a few bits per
listed host and reach the scan as scalar subqueries, so pages are neither joined nor shuffled.

A filter is an array of 64-bit words.  A list of more than ``KEYS`` hosts is divided by a hash of the host, and
each part of the pages then meets the cascade of its own part, so no filter outgrows the bound.

Cases: a url that is NULL or has no ``://`` has an empty host and path, fits no rule and is judged as the empty host.  NULL keys in
a list are left out.  Repeated rows are judged alike.  An empty table stays empty, an empty list blocks nothing.  Extra columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanpanel.llm.common import written

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
# Parts of host names that public block lists name for junk; fixed values of this filter.
JUNK_HOSTS = ("spam", "pills", "casino", "phish", "malware", "payday", "clickfarm", "warez")
FIRST, LATER = (4, 6), (1, 2)  # hashes and bits per key in the first level and in the others
KEYS = 20_000_000  # keys of a filter: 15 MB of bits


def parse(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    rest = F.when(url.contains("://"), F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)?", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; NULL where none does.  ``rules`` is a short list."""
    text = verdict = None
    for kind, name, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        if text is None:
            text, verdict = F.when(fits, name + start), F.when(fits, kind)
        else:
            text, verdict = text.when(fits, name + start), verdict.when(fits, kind)
    if text is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return text, verdict


class Bloom:
    """A filter over the ``key`` column of ``keys``, written as one row of words."""

    def __init__(self, keys: DataFrame, n: int, level: int):
        self.hashes, per_key = FIRST if level == 0 else LATER
        self.level, self.words = level, max(1, math.ceil(n * per_key / 64))
        at = F.explode(F.array(*[self._at(F.col("key"), j) for j in range(self.hashes)]))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
        hit = keys.select(at.alias("at")).groupBy(F.floor(F.col("at") / 64).alias("word")).agg(F.bit_or(bit).alias("bits"))
        every = keys.sparkSession.range(self.words).withColumnRenamed("id", "word").join(hit, "word", "left")
        pairs = F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
        self.table = written(every.agg(F.transform(pairs, lambda p: p["bits"]).alias("words")), "bloom")

    def _at(self, key: Column, j: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(self.level), F.lit(j)), F.lit(self.words * 64))

    def has(self, key: Column) -> Column:
        words = self.table.scalar()
        tests = []
        for j in range(self.hashes):
            at = self._at(key, j)
            word = F.element_at(words, (F.floor(at / 64) + 1).cast("int"))
            tests.append(F.call_function("shiftright", word, (at % 64).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return reduce(lambda a, b: a & b, tests)


def build_cascade(universe: DataFrame) -> list[Bloom]:
    """Filters that tell the ``listed`` keys of the universe (``key, listed``) from the others."""
    levels: list[Bloom] = []
    alive = universe
    while True:
        encoded = alive.where(F.col("listed") == F.lit(len(levels) % 2 == 0))
        n = encoded.count()
        if not n:
            return levels
        levels.append(Bloom(encoded.select("key"), n, len(levels)))
        alive = written(alive.where(levels[-1].has(F.col("key"))), "passed")


def is_listed(levels: list[Bloom], key: Column) -> Column:
    """Exact for keys of the universe: the first level missed decides."""
    out = F.lit(len(levels) % 2 == 1)
    for k in range(len(levels) - 1, -1, -1):
        out = F.when(~levels[k].has(key), F.lit(k % 2 == 1)).otherwise(out)
    return out


def junk_hosts(hosts: DataFrame) -> DataFrame:
    """The listed hosts of the default list: those with a junk part in their name."""
    return hosts.where(F.col("key").rlike("|".join(JUNK_HOSTS)))


def filter_urls(pages: DataFrame, listed: DataFrame | None = None, rules=RULES, keys: int = KEYS) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    ``listed`` has the blocked hosts in ``key``; by default the junk hosts of the corpus.
    """
    host, path = parse(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    hosts = parsed.select(F.col("host").alias("key")).groupBy("key").agg(F.lit(1).alias("seen"))
    hosts = written(hosts.select("key"), "hosts")
    listed = (junk_hosts(hosts) if listed is None else listed).select("key").where(F.col("key").isNotNull())
    marked = hosts.select("key", F.lit(True).alias("seen"), F.lit(False).alias("listed")).unionByName(
        listed.select("key", F.lit(False).alias("seen"), F.lit(True).alias("listed")))
    universe = written(marked.groupBy("key").agg(F.max("seen").alias("seen"), F.max("listed").alias("listed"))
                       .where("seen").select("key", "listed"), "universe")
    parts = max(1, math.ceil(universe.where("listed").count() / keys))

    def of(key: Column, part: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit("part")), F.lit(parts)) == part

    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    out = None
    for part in range(parts):
        mine = parsed if parts == 1 else parsed.where(of(F.col("host"), part))
        levels = build_cascade(universe if parts == 1 else universe.where(of(F.col("key"), part)))
        method = F.when(is_listed(levels, F.col("host")), "block").otherwise("allow")
        judged = mine.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))
        out = judged if out is None else out.unionByName(judged)
    return out
