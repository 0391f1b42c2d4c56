"""Spelling variants against brute force: all pairs of words by deleted and replaced letters."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from loanpanel.llm import queries, spelling

COLUMNS = [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]


def brute_words(rows):
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def brute(words):
    """Words that share a text with one letter wild, or that turn into each other by one deletion."""
    wild, near = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            wild[w[:k] + "*" + w[k + 1:]].add(w)
            shorter = w[:k] + w[k + 1:]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in wild.values():
        for a, b in itertools.permutations(group, 2):
            near[a].add(b)
    out = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 5 * n else None
        out[w] = [form, n, len(near[w]), words[form] if form else None]
    rows = []
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, n_near, form_n))
    return sorted(rows)


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows],
                                 "doc_id long, text string, word string, n int, key int, lang string").repartition(4)


def odd_rows():
    rng = random.Random(11)
    base = ["banana", "bananas", "anabana", "abababab", "ababababa", "aaaaaa", "aaaaaaa", "aaaaaaaa", "straße", "strasse", "crème brulée",
            "ÉCOLES", "écoles", "Écoles", "xyzzyx", "xyzyx", "naïveté", "naivete", "abcdef", "abcdeg", "abcdefg", "zabcdef", "bcdefg",
            "q" * 300, "q" * 301, "ab" * 200, "ab" * 200 + "c"]
    rows = [(k, " ".join(rng.choice(base) for _ in range(60))) for k in range(120)]
    letters = "abé"
    rows += [(k, " ".join("".join(rng.choice(letters) for _ in range(rng.choice((6, 6, 7)))) for _ in range(400))) for k in range(200, 240)]
    rows += [(500 + k, "common " * 60 + "commom " * 9 + "coommom" * (k % 2)) for k in range(12)]
    return rows + [(1, "BANANA banana-Banana1banana"), (1, "BANANA banana-Banana1banana"), (None, "banana bananas " * 9), (2, None), (3, ""),
                   (4, "×÷×÷×÷× " * 7), (5, "word" * 5_000 + " " + "word" * 5_000)] + [(6 + k, "w" * 20_000) for k in range(9)]


@pytest.mark.parametrize("kind", ["given", "odd", "none"])
def test_query(spark, sf, tmp_path, kind):
    folder = sf
    if kind != "given":
        folder = str(tmp_path / kind)
        docs_of(spark, odd_rows()).limit(0 if kind == "none" else 10**6).write.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = queries.corpus_queries()["op12_spelling_variants"](spark, folder)
    assert got.dtypes == COLUMNS
    want = brute(brute_words(rows))
    assert sorted(map(tuple, got.collect())) == want
    if kind == "odd":
        assert any(r[1] and r[2] != r[1] for r in want) and any(len(r[0]) > 1_000 for r in want)


def test_every_edit_meets(spark):
    """All words of a small alphabet: every pair one edit apart is found, no other one, and none twice."""
    words = {"".join(w) for n in (6, 7) for w in itertools.product("ab", repeat=n)} | {"".join(w) for w in itertools.product("abc", repeat=6)}
    table = spark.createDataFrame([(w, 5 + k % 7) for k, w in enumerate(sorted(words))], "word string, n long").repartition(5)
    got = [(r.word, r.other) for r in spelling.near_pairs(table).collect()]
    want = {(w, x) for w, _, _, _, _, _ in brute({w: 5 for w in words}) for x in words
            if w != x and abs(len(w) - len(x)) <= 1 and one_edit(w, x)}
    assert len(got) == len(set(got)) and set(got) == want


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(2)
    for _ in range(500):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(6, 12)))
        grams = sorted({word[k:k + 2] for k in range(len(word) - 1)})
        order = {g: (rank, n) for rank, (n, g) in enumerate(sorted((rng.randint(1, 9), g) for g in grams))}
        last, places, one, two = spelling.prefix_and_pivots(word, order)
        assert places == {g: (word.index(g), word.rindex(g)) for g in grams if order[g][0] <= last}
        pairs = [(order[g][1] + order[h][1], places[g][0], places[h][1]) for g in places for h in places
                 if places[h][1] - places[g][0] >= 2]
        assert two - one >= 2 and order[word[one:one + 2]][1] + order[word[two:two + 2]][1] == min(pairs)[0]
