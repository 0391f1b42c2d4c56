"""SimHash near-duplicates: fingerprints, and a binary trie self-join over them.

A fingerprint has a bit set when more than half the hashes of the text's word shingles have it.  Distinct fingerprints
are the leaves of a binary trie.  The self-join walks pairs of trie nodes of equal depth together,
starting with (root, root): a pair leads to the pairs of its children, a differing bit spends one of the error
budget, and a pair that has spent too much is dropped with all below it.

To spread the walk, two fingerprints within ``bits`` must agree on one of ``bits + 1`` blocks of their bits.  Each
fingerprint goes once into the subtrie of each block value (where those bits lead the way) and pairs are sought
inside a subtrie only.  A subtrie with too many leaves, such as one family of near copies with a
third of all rows, is divided the same way again by blocks of its other bits, and what is still large after ``LEVELS``
is dealt out as pairs of slices, all of them.  Equal fingerprints are one leaf, so no number of copies makes a
subtrie large.  Each task passes on a spanning forest of its links and not the links themselves.

Cases: NULL, empty and wordless texts have fingerprint zero and are linked like any other.  A text with fewer
words than a shingle is one shingle.  Repeated rows and NULL ids are rows like any other; a component
whose ids are all NULL has a NULL id.  Texts are hashed whole, whatever their length, bit counts being all that is kept of one.  An empty
table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanpanel.llm.common import map_texts, written
from loanpanel.llm.links import components
from loanpanel.sources.tables import BROADCAST_ROWS

SHINGLE = 3
MAX_BITS = 2
SEED = 42
LEAVES = 512  # least limit of a subtrie walked in one piece, see near_links; larger ones are divided
SLICES = 16  # a subtrie of up to so many pieces is dealt out as pairs of slices
LEVELS = 4
WALK = 1 << 18  # node pairs held at a time
PART = 1 << 16  # shingles counted at a time


def fingerprint(text: str | None, words_in: int = SHINGLE) -> int:
    """64-bit SimHash of the whole text."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # lower() of bytes changes A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= words_in:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts, stops = np.concatenate(([0], ends[:-1] + 1))[:len(words) - words_in + 1], ends[words_in - 1:]
    digest = xxhash.xxh64_intdigest
    count, total = np.zeros(64, np.int64), len(starts)
    for k in range(0, total, PART):
        cuts = zip(starts[k:k + PART].tolist(), stops[k:k + PART].tolist())
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in cuts), "<u8")
        count += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(count * 2 > total, bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, words_in: int = SHINGLE, keep: list[str] = ("doc_id",)) -> DataFrame:
    """``fp`` (as a signed long) beside the kept columns."""
    @F.pandas_udf("long")
    def of(texts):
        found = np.array([fingerprint(t, words_in) for t in texts], np.uint64)
        return pd.Series(found.view(np.int64))

    return docs.select(*keep, of(F.col("text")).alias("fp"))


# ---- the walk over pairs of trie nodes ----

def near_pairs(leaves: np.ndarray, group: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of leaves of one group that differ in at most ``bits`` bits.

    ``leaves`` are distinct within a group and sorted by (group, leaf): a trie node is a range of
    them, and one count of set bits per depth tells where its children part.
    """
    n = len(leaves)
    edges = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    low, high = edges[:-1], edges[1:]
    many = high - low > 1
    low, high = low[many], high[many]
    work = [(63, low, high, low, high, np.zeros(len(low), np.int8))]
    ones: dict[int, np.ndarray] = {}
    while work:
        depth, a0, a1, b0, b1, spent = work.pop()
        # Two single leaves: count the rest of their bits at once.
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            x, y = a0[single], b0[single]
            near = (np.bitwise_count(leaves[x] ^ leaves[y]) <= bits) & (x != y)
            if near.any():
                yield x[near], y[near]
            a0, a1, b0, b1, spent = (v[~single] for v in (a0, a1, b0, b1, spent))
        if not len(a0) or depth < 0:
            continue
        if len(a0) > WALK:  # depth first in halves, so that few pairs are held
            half = len(a0) // 2
            work.append((depth, a0[:half], a1[:half], b0[:half], b1[:half], spent[:half]))
            work.append((depth, a0[half:], a1[half:], b0[half:], b1[half:], spent[half:]))
            continue
        if depth not in ones:
            ones[depth] = np.concatenate(([0], np.cumsum(leaves >> np.uint64(depth) & np.uint64(1), dtype=np.int32)))
        count = ones[depth]
        am, bm = a1 - (count[a1] - count[a0]), b1 - (count[b1] - count[b0])
        same = (a0 == b0) & (a1 == b1)  # a node with itself: its mixed children are one pair, not two
        parts = []
        for left, right, cost, which in (((a0, am), (b0, bm), 0, None), ((am, a1), (bm, b1), 0, None),
                                         ((a0, am), (bm, b1), 1, None), ((am, a1), (b0, bm), 1, ~same)):
            ok = (left[1] > left[0]) & (right[1] > right[0]) & (spent + cost <= bits)
            if which is not None:
                ok &= which
            ok &= ~((left[1] - left[0] == 1) & (left[0] == right[0]) & (left[1] == right[1]))  # a leaf with itself
            parts.append([v[ok] for v in (*left, *right)] + [spent[ok] + np.int8(cost)])
        work.append((depth - 1, *(np.concatenate(v) for v in zip(*parts))))
    assert n == len(leaves)


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index of each index's component."""
    root = np.arange(n)
    for x, y in pairs:
        while True:
            rx, ry = root[x], root[y]
            open_ = rx != ry
            if not open_.any():
                break
            x, y = x[open_], y[open_]
            np.minimum.at(root, np.maximum(rx, ry)[open_], np.minimum(rx, ry)[open_])
            while not np.array_equal(up := root[root], root):
                root = up
    return root


# ---- spreading the walk ----

def block_masks(taken: int, blocks: int) -> list[int]:
    """The free bits (those outside ``taken``) in ``blocks`` runs, each joined to ``taken``."""
    free = [k for k in range(64) if not taken >> k & 1]
    return [taken | sum(1 << int(k) for k in run) for run in np.array_split(free, blocks)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def subtries(leaves: DataFrame, bits: int, size: int = LEAVES, slices: int = SLICES, levels: int = LEVELS) -> DataFrame:
    """``cell_mask, cell_value, x, y, side, fp``: rows to be walked together."""
    def into_blocks(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
        options = F.create_map(*[F.lit(v) for m, finer in masks.items()
                                 for v in (F.lit(_signed(m)), F.array(*[F.lit(_signed(f)) for f in finer]))])
        rows = rows.select("fp", F.explode(options[F.col("mask")]).alias("mask"))
        return rows.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))

    masks = {0: block_masks(0, bits + 1)}
    rows = into_blocks(leaves.select("fp", F.lit(0).cast("long").alias("mask")), masks)
    done = []
    for level in range(levels):
        # Keys with more than ``size`` leaves: at most (rows / size) of them.
        counts = written(rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > size), "large")
        if counts.isEmpty():
            break
        rows = written(rows, "subtries") if level else rows
        large = F.broadcast(counts) if counts.count() <= BROADCAST_ROWS else counts
        marked = rows.join(large, ["mask", "value"], "left")
        done.append(_cells(marked.where(F.col("n").isNull())))
        last = level == levels - 1
        sliced = marked.where(F.col("n") <= size * slices) if not last else marked.where(F.col("n").isNotNull())
        done.append(_cells(sliced, F.ceil(F.col("n") / size)))
        if last:
            rows = None
            break
        masks = {f: block_masks(f, bits + 1) for finer in masks.values() for f in finer}
        rows = into_blocks(marked.where(F.col("n") > size * slices).select("fp", "mask"), masks)
    if rows is not None:
        done.append(_cells(rows))
    out = done[0]
    for other in done[1:]:
        out = out.unionByName(other)
    return out


def _cells(rows: DataFrame, pieces: Column | None = None) -> DataFrame:
    """Deal each subtrie's leaves to all pairs (x <= y) of its slices."""
    if pieces is None:
        whole = F.lit(0).cast("long")
        return rows.select("fp", "mask", "value", whole.alias("x"), whole.alias("y"))
    rows = rows.withColumn("_of", pieces.cast("long")).withColumn("_own", F.pmod(F.xxhash64("fp"), F.col("_of")))
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_of") - 1), lambda other: F.struct(
        F.least("_own", other).alias("x"), F.greatest("_own", other).alias("y")))
    return rows.select("fp", "mask", "value", F.explode(pair).alias("_p")).select("fp", "mask", "value", "_p.x", "_p.y")


def near_links(leaves: DataFrame, bits: int = MAX_BITS, **limits) -> DataFrame:
    """Links ``a, b`` that connect exactly the distinct fingerprints ``fp`` within ``bits`` of each other.

    A subtrie may hold eight times the leaves that evenly spread fingerprints would give it, so that
    only unusual ones are divided, at any number of documents.
    """
    keys = ["mask", "value", "x", "y"]
    even = leaves.count() >> 64 // (bits + 1)
    cells = subtries(leaves, bits, **{"size": max(LEAVES, 8 * even)} | limits)
    dealt = cells.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def links(columns: list[np.ndarray]) -> pa.RecordBatch:
            fp, key = columns[0].view(np.uint64), columns[1:]
            fresh = np.zeros(len(fp), bool)
            for c in key:
                fresh[1:] |= c[1:] != c[:-1]
            group = np.cumsum(fresh)
            order = np.lexsort((fp, group))
            fp, group = fp[order], group[order]
            root = forest(len(fp), near_pairs(fp, group, bits))
            at = np.flatnonzero(root != np.arange(len(fp)))
            return pa.RecordBatch.from_arrays([pa.array(fp[root[at]].view(np.int64)), pa.array(fp[at].view(np.int64))],
                                              names=["a", "b"])

        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(columns[0]):
                continue
            held.append(columns)
            size += len(columns[0])
            if size < 1 << 17:
                continue
            joined = [np.concatenate(c) for c in zip(*held)]
            # The last key may go on in the next batch.
            tail = np.ones(size, bool)
            for c in joined[1:]:
                tail &= c == c[-1]
            keep = int(np.flatnonzero(~tail)[-1]) + 1 if not tail.all() else 0
            if keep:
                yield links([c[:keep] for c in joined])
            held, size = [[c[keep:] for c in joined]], size - keep
        if size:
            yield links([np.concatenate(c) for c in zip(*held)])

    return dealt.select("fp", *keys).mapInArrow(walk, "a long, b long")


def near_duplicates(docs: DataFrame, words_in: int = SHINGLE, bits: int = MAX_BITS,
                    keep: list[str] = ("doc_id",)) -> DataFrame:
    """Kept columns, ``fp``, ``component_id`` (smallest doc_id reachable) and ``component`` (smallest ``fp``)."""
    rows = written(fingerprints(docs, words_in, list(dict.fromkeys(["doc_id", *keep]))), "fingerprints")
    leaves = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "leaves")
    found = components(near_links(leaves, bits))
    grouped = leaves.join(found, leaves["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    grouped = written(grouped, "members")
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = grouped.join(least, "component").select(F.col("fp").alias("_fp"), "component_id", "component")
    return rows.join(classes, rows["fp"] == classes["_fp"]).drop("_fp")


def drop_near_duplicates(docs: DataFrame, words_in: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """One row of each component: that of the smallest doc_id, and of the first row among those."""
    copy = written(docs.withColumn("_llm_row", F.monotonically_increasing_id()), "numbered")
    rows = written(near_duplicates(copy, words_in, bits, ["_llm_row"]), "classes")
    first = rows.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull(), "doc_id", "_llm_row"))["_llm_row"].alias("_llm_keep"))
    drops = written(rows.join(first, rows["_llm_row"] == first["_llm_keep"], "left_anti").select("_llm_row"), "drops")
    small = drops.count() <= BROADCAST_ROWS
    return copy.join(F.broadcast(drops) if small else drops, "_llm_row", "left_anti").drop("_llm_row")
