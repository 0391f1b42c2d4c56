"""Spelling variants: words one edit apart, found by pivotal grams.

Words and their counts come from one pass over the texts.  Bigrams are ranked by the number of words that hold them, rare ones
first.  The gram prefix of a word is all its bigrams up to the rank of its third bigram; its pivots are two disjoint bigrams of the
prefix with the fewest words in all, chosen by dynamic programming over the positions.  Of two words one edit apart, call w the one whose
prefix ends at the lower rank.  The edit lies behind w's first pivot or before its second one, so a pivot is left untouched, and its
rank puts it in the other word's prefix.  All that lies on the pivot's other side is untouched as well, which limits its position: the first
pivot, the leftmost of its kind, is met at the same place from the start, and the second, the rightmost, at the same place from the end.

The index key holds that place.  Of the rest, where the edit is, one half is untouched too, and is part of the key; without it
the words with a frequent bigram at their start would all meet.  Pairs that meet are verified by their edit distance.

Cases: a NULL or empty text has no words; a NULL doc_id counts as empty text in ``<doc_id>:<run>``.  Repeated rows count each.  An empty
table, or one without words, gives no rows.  Texts and words are taken whole, whatever their length: work and rows are linear in it.  Ties of
counts go to the smaller word in code-point order.  Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanpanel.llm.common import map_texts, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
CUT = 199  # a run loses a code point where this divides its hash
LEAST_LENGTH, LEAST_COUNT, FACTOR = 6, 5, 5  # of a word; the form of a word has this many times its count
GRAM = 2
ALPHABET = 26 + 64  # letters of lower-cased runs, so there are at most ALPHABET ** 2 bigrams


def word_of(doc_id: int | None, run: str) -> str:
    """The word that a lower-cased run of a document stands for."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % CUT:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` of all words that are long and frequent enough.  Counted in each batch of texts before the shuffle."""
    def begin():
        def count(ids, texts):
            total: Counter[str] = Counter()
            for doc, text in zip(ids.to_pylist(), texts):
                runs: Counter[str] = Counter()
                for run, n in Counter(RUN.findall(text.as_py() or "")).items():
                    runs[run.translate(LOWER)] += n
                for run, n in runs.items():
                    if len(run) >= LEAST_LENGTH:
                        total[word_of(doc, run)] += n
            return zip(*((word, n) for word, n in total.items() if len(word) >= LEAST_LENGTH)) if total else ([], [])
        return lambda columns: _columns(count(*columns), 2)

    counted = map_texts(docs.select("doc_id", "text"), "word string, n long", begin)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _columns(rows, n: int) -> list:
    return list(rows) or [[]] * n


def gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """``(rank, number of words)`` by bigram, rare ones first; at most ``ALPHABET ** 2`` entries."""
    def begin():
        def count(column):
            total = Counter(g for word in column.to_pylist() for g in {word[k:k + GRAM] for k in range(len(word) - 1)})
            return list(total), list(total.values())
        return lambda columns: count(*columns)

    held = map_texts(words.select("word"), "gram string, n long", begin).groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: (rank, r["n"]) for rank, r in enumerate(held.orderBy("n", "gram").collect())}


def prefix_and_pivots(word: str, order: dict[str, tuple[int, int]]) -> tuple[int, dict[str, tuple[int, int]], int, int]:
    """``(last rank of the prefix, first and last place of its bigrams, place of the first pivot, of the second)``."""
    grams = [word[k:k + GRAM] for k in range(len(word) - 1)]
    last = sorted(order[g][0] for g in grams)[2]
    places: dict[str, tuple[int, int]] = {}
    for k, g in enumerate(grams):
        if order[g][0] <= last:
            places[g] = (places[g][0] if g in places else k, k)
    firsts = {first: g for g, (first, _) in places.items()}
    lasts = {final: g for g, (_, final) in places.items()}
    # best[k]: the cheapest first pivot that starts at k or before; the pair ends with a second one GRAM or more behind it
    cheapest, pair, opened = None, None, iter(sorted(firsts))
    start = next(opened, None)
    for end in sorted(lasts):
        while start is not None and start <= end - GRAM:
            cheapest = min(x for x in (cheapest, (order[firsts[start]][1], start)) if x is not None)
            start = next(opened, None)
        if cheapest is not None:
            found = (cheapest[0] + order[lasts[end]][1], cheapest[1], end)
            pair = found if pair is None else min(pair, found)
    return last, places, pair[1], pair[2]


def _halves(rest: str) -> list[tuple[int, str, str]]:
    """What an edit may leave alone of ``rest``, as (length of the shorter one of the two, which half, its text).

    The shorter text has a cut in its middle: an edit before the cut leaves all behind it, and an edit behind it all before it.
    A text is the shorter one, or equally long, or longer by one.
    """
    out = []
    for shorter in (len(rest), len(rest) - 1):
        if shorter >= 0:
            cut = shorter // 2
            out += [(shorter, "a", rest[:cut]), (shorter, "z", rest[len(rest) - (shorter - cut):])]
    return out


def _key(*parts) -> int:
    unsigned = xxhash.xxh64_intdigest("\0".join(map(str, parts)).encode())
    return unsigned - 2**64 if unsigned >= 2**63 else unsigned


def index_rows(words: DataFrame, order: dict[str, tuple[int, int]]) -> DataFrame:
    """``pivot, key, word, n, last``: the entries of the pivots (``pivot`` true) and of the prefixes of all words."""
    def begin():
        def entries(column, counts):
            rows = []
            for word, n in zip(column.to_pylist(), counts.to_pylist()):
                last, places, one, two = prefix_and_pivots(word, order)
                for first, final in places.values():
                    for side, kept, rest, is_pivot in (
                            ("start", word[:first + GRAM], word[first + GRAM:], first == one),
                            ("end", word[final:], word[:final], final == two)):
                        for half in _halves(rest):
                            key = _key(side, kept, *half)
                            rows.append((False, key, word, n, last))
                            if is_pivot:
                                rows.append((True, key, word, n, last))
            return zip(*rows)
        return lambda columns: _columns(entries(*columns), 5)

    return map_texts(words.select("word", "n"), "pivot boolean, key long, word string, n long, last int", begin)


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, n, other, other_n``: all pairs of words one edit apart, in both directions."""
    rows = written(index_rows(words, gram_order(words)), "grams")
    a = rows.where("pivot").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("last").alias("a_last"))
    b = rows.where("NOT pivot").select("key", F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("last").alias("b_last"))
    met = a.join(b, (a["key"] == b["key"]) & (F.col("a_last") <= F.col("b_last")) & (F.col("a") != F.col("b"))
                 & (F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein(F.col("a"), F.col("b"), 1) == 1))
    pairs = met.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"),
                       _of("low", "a", "b"), _of("high", "a", "b")).distinct()
    both = F.explode(F.array(F.struct(F.col("low").alias("word"), F.col("low_n").alias("n"), F.col("high").alias("other"),
                                      F.col("high_n").alias("other_n")),
                             F.struct(F.col("high").alias("word"), F.col("high_n").alias("n"), F.col("low").alias("other"),
                                      F.col("low_n").alias("other_n"))))
    return pairs.select(both.alias("p")).select("p.*")


def _of(which: str, a: str, b: str) -> Column:
    first = F.col(a) < F.col(b)
    return F.when(first if which == "low" else ~first, F.col(f"{a}_n")).otherwise(F.col(f"{b}_n")).alias(f"{which}_n")


def follow(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: forms followed to the last.

    A form has ``FACTOR`` times the count of its word, so there are no rings, and chains grow with the log of the counts; each
    round doubles the steps taken.
    """
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = reached.select(F.col("word").alias("via"), F.col("root").alias("to"))
        longer = reached.join(onward, reached["root"] == onward["via"], "left")
        if longer.where(F.col("to").isNotNull()).isEmpty():
            return reached
        reached = written(longer.select("word", F.coalesce("to", "root").alias("root")), "roots")


def group_variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the texts."""
    words = written(count_words(docs), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("low"), F.col("other").alias("other")))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = words.join(near.withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left")
    is_form = -F.col("best.low") >= FACTOR * F.col("n")
    found = written(known.select("word", F.when(is_form, F.col("best.other")).alias("form"), "n",
                                 F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                 F.when(is_form, -F.col("best.low")).alias("form_n")), "near-words")
    roots = follow(found.where(F.col("form").isNotNull()).select("word", "form")).withColumnRenamed("word", "_word")
    return found.join(roots, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
