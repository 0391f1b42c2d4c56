"""Language identification by prediction by partial matching.

For each language, counts of the byte that follows each context of up to
``ORDER`` bytes form a context tree.  A byte is coded in the longest context; a byte new to a
context costs that context's escape probability and is coded in the next shorter one,
without the bytes already excluded, down to a uniform code over all 256 bytes.  The
statistics are frozen after training, so the code length of a text is exact and does
not depend on other texts.  The language with the shortest code is predicted.

Contexts of all languages are one automaton (states are the contexts, a byte leads to the
longest known one), so a whole text is scored with a few table lookups per byte.

Training reads about ``TRAIN_ROWS`` whole texts per language, drawn by a hash of the id.

Cases: a text that is NULL or has no letter is ``und`` with score 0, as is everything when
nothing can be learned.  Equal code lengths go to the first language by name.  Rows with a NULL doc_id are never
learned from and count as not held out.  Repeated rows are scored alike.  Texts are scored whole, whatever their length.  An empty table
gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanpanel.llm.common import map_texts

ORDER = 3  # bytes in the longest context
TRAIN_ROWS = 300  # expected rows per language
MIN_CONTEXT = 6  # a context seen less often is left to the shorter ones
PIECE = 1 << 19  # bytes scored at a time
UNKNOWN = "und"


def gram_counts(sample: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, size, gram, n``: how often each run of up to ``order + 1`` bytes occurs."""
    def begin():
        def count(langs, texts):
            found: dict[tuple, int] = {}
            for lang, text in zip(langs.to_pylist(), texts):
                data = np.frombuffer((text.as_py() or "").encode("utf-8", "replace"), np.uint8).astype(np.int64)
                code = np.zeros(len(data), np.int64)
                for size in range(1, order + 2):
                    if len(data) < size:
                        break
                    code = (code[:-1] if size > 1 else code) * 256 + data[size - 1:]
                    for gram, n in zip(*(x.tolist() for x in np.unique(code, return_counts=True))):
                        found[lang, size, gram] = found.get((lang, size, gram), 0) + n
            return list(zip(*((*k, n) for k, n in found.items()))) if found else [[]] * 4
        return lambda columns: count(*columns)

    counted = map_texts(sample.select("lang", "text"), "lang string, size int, gram long, n long", begin)
    return counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Trees:
    """Frozen statistics of all languages: ``step[state, symbol]`` and ``bits[state, symbol, language]``."""

    langs: list[str]
    symbol: np.ndarray  # of each byte; 0 is the gap between texts, 1 a byte never seen
    step: np.ndarray
    bits: np.ndarray
    order: int

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each whole text under each language."""
        out = np.zeros((len(texts), len(self.langs)))
        group, size = [], 0
        for k, text in enumerate(texts):
            group.append(k)
            size += len(text) + 1
            if size >= PIECE:
                self._score(texts, group, out)
                group, size = [], 0
        self._score(texts, group, out)
        return out

    def _score(self, texts: list[bytes], group: list[int], out: np.ndarray) -> None:
        if not group:
            return
        joined = b"".join(texts[k] for k in group)
        lengths = np.array([len(texts[k]) for k in group])
        owner = np.repeat(np.arange(len(group)), lengths + 1)
        symbols = np.zeros(len(owner), np.int64)  # a gap stands before every text
        gap = np.cumsum(lengths + 1) - lengths - 1
        inside = np.ones(len(owner), bool)
        inside[gap] = False
        symbols[inside] = self.symbol[np.frombuffer(joined, np.uint8)]
        for start in range(0, len(symbols), PIECE):
            first = max(0, start - self.order)
            part = symbols[first:start + PIECE]
            state = self.step[0, part]
            for _ in range(1, self.order):
                state[1:] = self.step[state[:-1], part[1:]]
            before = np.concatenate(([0], state[:-1]))
            cost = self.bits[before, part][start - first:]
            of = owner[start:start + PIECE]
            cuts = np.flatnonzero(np.diff(of, prepend=-1))
            out[np.array(group)[of[cuts]]] += np.add.reduceat(cost, cuts, axis=0, dtype=np.float64)


def build(counts: list[tuple[str, int, int, int]], order: int = ORDER, least: int = MIN_CONTEXT) -> Trees:
    """Context trees from gram counts; the table holds contexts x seen bytes x languages numbers."""
    langs = sorted({lang for lang, *_ in counts})
    seen = sorted({gram for _, size, gram, _ in counts if size == 1})
    symbol = np.ones(256, np.int64)
    symbol[seen] = np.arange(2, len(seen) + 2)
    width = len(seen) + 2
    follow: dict[bytes, dict[int, list[tuple[int, int]]]] = {}
    totals: dict[bytes, int] = {}
    for lang, size, gram, n in counts:
        data = int(gram).to_bytes(size, "big")
        follow.setdefault(data[:-1], {}).setdefault(langs.index(lang), []).append((int(symbol[data[-1]]), n))
        totals[data[:-1]] = totals.get(data[:-1], 0) + n
    contexts = [b""] + sorted((c for c, n in totals.items() if c and n >= least), key=lambda c: (len(c), c))
    number = {c: k for k, c in enumerate(contexts)}

    def shorter(context: bytes) -> int:
        while context not in number:
            context = context[1:]
        return number[context]

    step = np.zeros((len(contexts), width), np.int64)
    chance = np.zeros((len(contexts), width, len(langs)))
    for c, k in number.items():
        suffix = shorter(c[1:]) if c else None
        base = np.full((width, len(langs)), 1 / 256) if suffix is None else chance[suffix]
        if suffix is not None:
            step[k] = step[suffix]
        chance[k] = base
        for lang, pairs in follow[c].items():
            at = np.array([s for s, _ in pairs])
            n = np.array([m for _, m in pairs], float)
            all_n, kinds = n.sum(), len(n)
            left = 1 - base[at, lang].sum()
            if left > 1e-9:
                chance[k, :, lang] = kinds / (all_n + kinds) * base[:, lang] / left
                chance[k, at, lang] = n / (all_n + kinds)
            else:  # every byte is known here: nothing to escape to
                chance[k, at, lang] = n / all_n
    for c, k in number.items():
        if c:  # reading its last byte in the state of the rest leads to this context
            parent = number.get(c[:-1])
            if parent is not None:
                step[parent, symbol[c[-1]]] = k
    for c, k in sorted(number.items(), key=lambda x: len(x[0])):
        if c:
            suffix = shorter(c[1:])
            own = np.array([number.get(c + bytes([b])) or 0 for b in seen], np.int64) if len(c) < order else 0
            step[k, 2:] = np.where(own, own, step[suffix, 2:])
    bits = -np.log2(np.maximum(chance, 1e-300))
    bits[:, 0] = 0  # the gap between texts costs nothing and forgets the context
    step[:, 0] = 0
    return Trees(langs, symbol, step.astype(np.int32), bits.astype(np.float32), order)


def train(docs: DataFrame, usable: Column, rows: int = TRAIN_ROWS, order: int = ORDER) -> Trees | None:
    """Trees learned from about ``rows`` usable rows per language.  None without any."""
    known = docs.where(usable & F.col("lang").isNotNull()).select("lang", "text", "doc_id")
    sizes = [(r["lang"], r["n"]) for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()]
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1_000_000_007)) / 1_000_000_007.0
    share = F.create_map(*[F.lit(x) for lang, n in sizes for x in (lang, min(1.0, rows / n))])
    sample = known.where(draw < share[F.col("lang")])
    counts = [tuple(r) for r in gram_counts(sample, order).collect()]
    return build(counts, order) if counts else None


def identify(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """``doc_id, lang_pred, score``: one pass; the trees go to each executor once.

    The score is the share of the winning language when every language is as
    likely beforehand.
    """
    spark = docs.sparkSession
    if trees is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(trees)

    def begin():
        model = shared.value
        names = np.array([*model.langs, UNKNOWN], object)

        def predict(ids, texts, letters):
            lettered = np.array([bool(x) for x in letters.to_pylist()], bool)
            data = [(t.as_py() or "").encode("utf-8", "replace") if ok else b"" for t, ok in zip(texts, lettered)]
            cost = model.code_lengths(data)
            if not len(cost):
                return [], [], []
            best = cost.argmin(axis=1)
            with np.errstate(under="ignore"):
                share = 1 / np.exp2(np.maximum(cost.min(axis=1, keepdims=True) - cost, -1000)).sum(axis=1)
            return ids, list(names[np.where(lettered, best, len(model.langs))]), list(np.where(lettered, share, 0.0))
        return lambda columns: predict(*columns)

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return map_texts(docs.select("doc_id", "text", lettered.alias("letters")),
                     "doc_id long, lang_pred string, score double", begin)
