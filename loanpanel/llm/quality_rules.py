"""Quality rules: word counts and repeats, and compression bands.

Text that repeats itself compresses better than prose of its length, and text without structure (keys, encoded blobs) hardly at
all.  Every text is compressed whole and in fixed chunks.  What ratio prose of a length has is read off the corpus: the
median of each length class, an octave of bytes, and the spread of ratios around the line through the medians, over all documents that pass the
base rules, copies counted once.  A text is rejected when its ratio lies too many spreads above or below the line, or when too
many of its chunks lie outside the band for their own length.  Fixed outer limits hold whatever the corpus is.

Cases: a NULL or empty text has no words and fails the base rules.  Long texts are compressed whole.  A chunk's end that is shorter than a
chunk belongs to the last one, so a text below two chunks is one chunk.  Repeated rows are judged alike, each on its own.  A NULL
doc_id stays NULL.  An empty table gives no rows; where one document passes the base rules it is the corpus's own median and
is kept unless the fixed limits reject it.  Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from loanpanel.llm.common import bound_batches, map_texts, written

LEVEL = 3
CHUNK = 2048  # bytes of a chunk; the last one has what is left over besides
CHUNK_SHARE = 0.3  # reject when more than this share of the chunks is outside
ABOVE, BELOW = 2.5, 5.0  # spreads above and below the line where a ratio is rejected
LEAST_SPREAD = 0.05  # of the ratios of a length class
BIN = 0.001  # ratios are counted in bins of this width
LAST_BIN = 20_000  # and those beyond this one together
CHUNK_BAND = (1.4, 4.0)  # outer limits of a chunk's ratio
LOW_BANDS = ((1024, 1.4), (512, 1.25), (256, 1.15), (0, 0.0))  # outer limit: bytes from, least ratio
HIGH_AT_256, HIGH_PER_DOUBLING = 2.5, 0.25  # outer limit: largest ratio at 256 bytes, and what each doubling adds

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT = 0.5

MEASURES = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "base_failed boolean, size long, ratio double, chunk_ratios array<double>")
JUDGED = MEASURES.replace("chunk_ratios array<double>", "chunks_outside double, kept boolean")


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that occurs twice or more, the first one included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    inside = np.zeros(len(words), bool)
    again = np.fromiter((seen[w] > 1 for w in windows), bool, len(windows))
    for k in range(3):
        inside[k:k + len(again)] |= again
    return int(inside.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    data = text.encode("utf-8", "replace")
    words = data.split()
    spaces = len(data) - len(data.translate(None, SPACES))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated_words(words)


def compression(data: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, list[float]]:
    """Ratio of the whole text, and of each of its chunks."""
    if not data:
        return 0.0, []
    view, whole = memoryview(data), len(data) / len(packer.compress(data))
    starts = range(0, max(len(data) // CHUNK, 1) * CHUNK, CHUNK)
    if len(starts) == 1:
        return whole, [whole]
    parts = [view[k:k + CHUNK] for k in starts[:-1]] + [view[starts[-1]:]]
    return whole, [len(part) / len(packer.compress(part)) for part in parts]


def outer_limits(size: int) -> tuple[float, float]:
    """Least and largest ratio for a text of so many bytes, in any corpus."""
    low = next(ratio for start, ratio in LOW_BANDS if size >= start)
    return low, HIGH_AT_256 + HIGH_PER_DOUBLING * max(0.0, float(np.log2(max(size, 1) / 256)))


@dataclass
class Bands:
    """The line of usual ratios, through a point per length class, and the spread around it."""

    at: list[float]  # log2 of bytes
    usual: list[float]
    spread: list[float]

    def fits(self, size: int, ratio: float) -> bool:
        if not self.at:
            return True
        lg = float(np.log2(max(size, 1)))
        away = ratio - float(np.interp(lg, self.at, self.usual))
        spread = self.spread[int(np.argmin(np.abs(np.array(self.at) - lg)))]
        return -BELOW * spread <= away <= ABOVE * spread

    def outside(self, size: int, chunk_ratios: list[float]) -> float:
        """Share of the chunks outside the band for their length."""
        if not chunk_ratios:
            return 0.0
        last = size - (len(chunk_ratios) - 1) * CHUNK
        sizes = [CHUNK] * (len(chunk_ratios) - 1) + [last]
        bad = sum(not (self.fits(n, r) and (n < CHUNK or CHUNK_BAND[0] <= r <= CHUNK_BAND[1])) for n, r in zip(sizes, chunk_ratios))
        return bad / len(chunk_ratios)

    def keeps(self, size: int, ratio: float, chunk_ratios: list[float]) -> bool:
        """True for text whose compression is that of prose."""
        low, high = outer_limits(size)
        return low <= ratio <= high and self.fits(size, ratio) and self.outside(size, chunk_ratios) <= CHUNK_SHARE


def measure(text: str | None, packer: zstandard.ZstdCompressor) -> tuple:
    """Base counts, base verdict, bytes, ratio and chunk ratios of a text."""
    text = text or ""
    counts, data = base_counts(text), text.encode("utf-8", "replace")
    failed = counts[0] < MIN_WORDS or counts[4] > MAX_REPEAT * counts[0]
    return (*counts, failed, len(data), *compression(data, packer))


def _packer() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)


def measured(docs: DataFrame) -> DataFrame:
    """``MEASURES`` of every document, written: one pass over the texts, a few numbers for each."""
    def begin():
        packer = _packer()

        def work(ids, texts):
            rows = [(doc.as_py(), *measure(text.as_py(), packer)) for doc, text in zip(ids, texts)]
            return list(zip(*rows)) if rows else [[]] * 10
        return lambda columns: work(*columns)

    return written(map_texts(docs.select("doc_id", "text"), MEASURES, begin), "quality-measures")


def _quantile(counts: list[tuple[int, int]], p: float) -> float:
    """Smallest bin whose cumulative share reaches p."""
    counts = sorted(counts)
    need, seen = p * sum(n for _, n in counts), 0
    for at, n in counts:
        seen += n
        if seen >= need:
            return at * BIN
    return 0.0


def fit_bands(measures: DataFrame) -> Bands:
    """Bands from all documents that pass the base rules, equal sizes and ratios counted once.

    The driver gets counts per (length class, bin of ratios): some dozen classes of at most ``LAST_BIN`` bins.
    """
    lg = F.log2("size")
    once = written(measures.where("NOT base_failed").select("size", "ratio").distinct().select(
        lg.alias("lg"), F.floor(lg).cast("int").alias("octave"), "ratio"), "quality-ratios")
    places = {r["octave"]: r["s"] / r["n"] / 1e6 for r in once.groupBy("octave").agg(
        F.sum(F.round(F.col("lg") * 1e6).cast("long")).alias("s"), F.count(F.lit(1)).alias("n")).collect()}

    def binned(value) -> dict[int, list[tuple[int, int]]]:
        at = F.greatest(F.least(F.floor(value / BIN), F.lit(LAST_BIN)), F.lit(-LAST_BIN)).cast("int")
        out: dict[int, list[tuple[int, int]]] = {}
        for r in once.groupBy("octave", at.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect():
            out.setdefault(r["octave"], []).append((r["at"], r["n"]))
        return out

    octaves = sorted(places)
    if not octaves:
        return Bands([], [], [])
    medians = binned(F.col("ratio"))
    at, usual = [places[k] for k in octaves], [_quantile(medians[k], 0.5) for k in octaves]
    # The line as an expression: the last segment that starts at or below a length, or the first point before all.
    line = F.lit(usual[0])
    for k in range(len(at)):
        slope = (usual[k + 1] - usual[k]) / (at[k + 1] - at[k]) if k + 1 < len(at) else 0.0
        line = F.when(F.col("lg") >= at[k], F.lit(usual[k]) + (F.col("lg") - F.lit(at[k])) * F.lit(slope)).otherwise(line)
    away = binned(F.col("ratio") - line)
    pooled = Counter()
    for counts in away.values():
        pooled.update(dict(counts))

    def spread(counts) -> float:
        return _quantile(list(counts), 0.5) - _quantile(list(counts), 0.1)

    least = max(LEAST_SPREAD, spread(pooled.items()))
    return Bands(at, usual, [max(least, spread(away[k])) for k in octaves])


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document with its counts, ratio, ``base_failed`` and ``kept``.

    Texts are read and compressed once; the bands and the verdicts come from the written measures.
    """
    measures = measured(docs)
    bands = fit_bands(measures)

    def begin():
        def judge(*columns):
            failed, sizes, ratios, chunks = (c.to_pylist() for c in columns[6:])
            outside = [bands.outside(n, c) for n, c in zip(sizes, chunks)]
            kept = [not bad and bands.keeps(n, r, c) for bad, n, r, c in zip(failed, sizes, ratios, chunks)]
            return [*columns[:9], outside, kept]
        return lambda columns: judge(*columns)

    return map_texts(measures, JUDGED, begin)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that ``quality_rules`` keeps, with all their columns.

    The bands are fitted first; the verdict is then computed next to the row it belongs to, so no join is needed.
    """
    bound_batches(docs.sparkSession)
    bands = fit_bands(measured(docs))

    @pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        packer = _packer()
        found = (measure(text, packer) for text in texts)
        return pd.Series([not failed and bands.keeps(size, ratio, chunks) for *_, failed, size, ratio, chunks in found], dtype=bool)

    return docs.where(good(F.col("text")))
