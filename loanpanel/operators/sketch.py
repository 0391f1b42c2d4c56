"""Counts and a balanced draw from one pass, by bottom-k sketches.

A row is drawn when its key digest lies below its stratum's bound, and the bound follows from the counts of all strata.  Both come from one
scan: every task counts its strata and keeps the rows of lowest digest of each, as many as an even share of the sample
asks for and some more.  It notes below which digest its rows of a stratum are complete.  Once the counts are added up and the bounds are
known, a stratum whose bound lies within what all tasks kept is drawn from the kept rows.  Others, found only where a
stratum is spread very unevenly over the tasks, are drawn from the source again.  The rows are those of the two-pass draw.

Arrow takes microseconds to hand over a row, so this is for rows that take longer to make, not for exploded pairs.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loanpanel.functions.expr import digest_bound, key_digest
from loanpanel.operators.sampling import SEED, strata_rates
from loanpanel.sources.tables import join_small, stage

# Executors get these functions themselves: they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MORE = 2.0  # times a task's even share of the sample that it keeps
LEAST = 4096  # rows that a task keeps anyway
BUFFER = 65_536  # rows beyond what is kept before a task sorts again
DIGITS = 8  # of the digest; as eight bytes they compare like a number
NO_END = "g"  # beyond every digest


def _cap(sizes: np.ndarray, wanted: float) -> float:
    """The c with sum(min(size, c)) = wanted; infinite when all rows are not enough."""
    if sizes.sum() <= wanted:
        return math.inf
    ordered = np.sort(sizes)
    before = np.concatenate(([0], np.cumsum(ordered)[:-1]))
    caps = (wanted - before) / np.arange(len(ordered), 0, -1)
    return float(caps[np.argmax(caps <= ordered)])


class BottomRows:
    """Counts of strata and their rows of lowest digest, within about ``share`` rows in all."""

    def __init__(self, strata: list[str], share: float):
        self.strata, self.share = strata, share
        self.ids: dict[tuple, int] = {}
        self.n = np.zeros(0, np.int64)
        self.below = np.zeros(0, np.uint64)  # rows of the stratum are complete below this digest
        self.kept: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, batch: pa.RecordBatch) -> None:
        own = self._ids_of(batch)
        digest = _digests(batch.column(batch.num_columns - 1))
        self.n += np.bincount(own, minlength=len(self.n))
        low = np.flatnonzero(digest < self.below[own])
        if len(low):
            self.kept.append((batch.take(pa.array(low)), own[low], digest[low]))
            self.rows += len(low)
        if self.rows > 2 * self.share + BUFFER:
            self.shrink()

    def _ids_of(self, batch: pa.RecordBatch) -> np.ndarray:
        n, code, size = batch.num_rows, np.zeros(batch.num_rows, np.int64), 1
        for name in self.strata:
            levels = batch.column(name).dictionary_encode(null_encoding="encode")
            code = code * len(levels.dictionary) + levels.indices.to_numpy(zero_copy_only=False)
            size *= len(levels.dictionary)
            if size > 4 * n:  # few of the combinations are there: number those
                _, code = np.unique(code, return_inverse=True)
                size = int(code.max()) + 1
        first = np.full(size, -1)
        first[code[::-1]] = np.arange(n)[::-1]
        present = first >= 0
        first, inverse = first[present], (np.cumsum(present) - 1)[code]
        found = zip(*(batch.column(name).take(pa.array(first)).to_pylist() for name in self.strata))
        own = np.array([self.ids.setdefault(level, len(self.ids)) for level in found], np.int64)
        new = len(self.ids) - len(self.n)
        if new:
            self.n = np.concatenate((self.n, np.zeros(new, np.int64)))
            self.below = np.concatenate((self.below, np.full(new, np.iinfo(np.uint64).max, np.uint64)))
        return own[inverse]

    def shrink(self) -> None:
        """Drop what a balanced draw of ``share`` rows from the counts so far does not reach; later counts only lower the reach."""
        cap = _cap(self.n, self.share)
        if not self.kept or cap == math.inf:
            return
        own, digest = (np.concatenate([part[k] for part in self.kept]) for k in (1, 2))
        order = np.lexsort((digest, own))
        sizes = np.bincount(own, minlength=len(self.n))
        starts = np.cumsum(sizes) - sizes
        take = math.ceil(cap) + 1
        for k in np.flatnonzero(sizes > take):
            self.below[k] = digest[order[starts[k] + take]]
        left = np.flatnonzero(digest < self.below[own])
        table = pa.Table.from_batches([part[0] for part in self.kept]).take(pa.array(left)).combine_chunks()
        batches = table.to_batches()
        self.kept = [(batches[0], own[left], digest[left])] if batches else []
        self.rows = len(left)


def _digests(column: pa.Array) -> np.ndarray:
    """The digests as numbers of the same order."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset) if len(column) else np.zeros(1, np.int32)
    start = int(offsets[0])
    return np.frombuffer(column.buffers()[2], ">u8", len(column), start).astype(np.uint64) if len(column) else np.zeros(0, np.uint64)


def _task(strata: list[str], share: float, schema: pa.Schema):
    """Task body: kept rows with their digest, then a row per stratum with its count and where its rows end."""
    def run(batches):
        held = BottomRows(strata, share)
        for batch in batches:
            if batch.num_rows:
                held.add(batch)
        held.shrink()
        for batch, _, _ in held.kept:
            yield pa.RecordBatch.from_arrays(
                [*(c.cast(schema.field(k).type) for k, c in enumerate(batch.columns)),
                 *(pa.nulls(batch.num_rows, schema.field(name).type) for name in ("_n", "_below"))], schema=schema)
        if held.ids:
            levels = dict(zip(strata, zip(*held.ids)))
            ends = [NO_END if b == np.iinfo(np.uint64).max else int(b).to_bytes(DIGITS, "big").decode() for b in held.below]
            known = levels | {"_n": held.n.tolist(), "_below": ends}
            yield pa.RecordBatch.from_arrays(
                [pa.array(known[f.name], f.type) if f.name in known else pa.nulls(len(ends), f.type) for f in schema], schema=schema)
    return run


def least_tasks(rows: DataFrame) -> int:
    """A number of tasks that a scan has at least, known without planning or running it: its files, as far as there are cores."""
    return max(1, min(rows.sparkSession.sparkContext.defaultParallelism, len(rows.inputFiles())))


def sketched(rows: DataFrame, strata: list[str], target_n: int, keys: list[str], seed: int = SEED, more: float = MORE,
             least: int = LEAST, tasks: int | None = None) -> DataFrame:
    """Staged ``keys, strata, _d, _n, _below``: rows of low digest (``_n`` NULL), and counts per task and stratum.

    ``tasks`` is the number that an even share is reckoned with; fewer than there are only make tasks keep more.
    """
    thin = rows.select(*dict.fromkeys([*keys, *strata]), F.substring(key_digest(*keys, seed=seed), 1, DIGITS).alias("_d"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in thin.schema.fields]).add("_n", "long").add("_below", "string")
    share = max(more * target_n / (tasks or least_tasks(rows)), least)
    return stage(thin.mapInArrow(_task(strata, share, to_arrow_schema(schema)), schema), "bottom-rows")


def draw_in_one_pass(rows: DataFrame, strata: list[str], target_n: int, keys: list[str], seed: int = SEED, more: float = MORE,
                     least: int = LEAST, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(keys and strata of the drawn rows, strata table)``: the same as ``strata_rates`` and ``stratified_sample``.

    ``rows`` is scanned once, and once more only for strata that the sketch has too few rows of.
    """
    columns = list(dict.fromkeys([*keys, *strata]))
    sketch = sketched(rows, strata, target_n, keys, seed, more, least, tasks)
    counts = stage(sketch.where(F.col("_n").isNotNull()).groupBy(*strata).agg(
        F.sum("_n").alias("n"), F.min("_below").alias("_below")), "sketch-counts")
    rates = strata_rates(rows, strata, target_n, counts.select(*strata, "n"))
    bounds = stage(join_small(rates.select(*strata, digest_bound(F.col("rate")).alias("_bound")), counts.select(*strata, "_below"),
                              strata).select(*strata, "_bound", (F.col("_bound") > F.col("_below")).alias("_short")), "bounds")
    found = join_small(sketch.where(F.col("_n").isNull()).select(*columns, "_d"), bounds.where("NOT _short"), strata, sizes=rates)
    drawn = found.where(F.col("_d") < F.col("_bound")).select(*columns)
    if not (short := bounds.where("_short")).isEmpty():
        again = join_small(rows.select(*columns), short, strata, sizes=rates)
        drawn = drawn.unionByName(again.where(key_digest(*keys, seed=seed) < F.col("_bound")).select(*columns))
    return drawn, rates
