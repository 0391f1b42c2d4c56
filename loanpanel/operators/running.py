"""Exact running totals, quantiles and ranks without a one-task window.

Rows are first counted into cells, one per (group, distinct value), with
map-side partial sums: a value held by a third of all rows becomes one cell.
Cells are then cut into value ranges.  Totals per (group, range) are tiny and
give each range its starting offset; the window inside a range sees only that
range's cells.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanpanel.functions.expr import hash28, HASH_SPAN
from loanpanel.sources.tables import join_small, stage

CELLS_PER_TASK = 1_000_000
MAX_RANGES = 4096


def _with_value_range(cells: DataFrame, order: str, ranges: int) -> DataFrame:
    """Add ``_range``: which of ``ranges`` roughly equal value intervals the cell is in."""
    probs = [(i + 1) / ranges for i in range(ranges - 1)]
    cuts = sorted(set(cells.approxQuantile(order, probs, 0.25 / ranges)))
    splits = [-float("inf"), *cuts, float("inf")]
    return Bucketizer(splits=splits, inputCol=order, outputCol="_range", handleInvalid="keep").transform(cells)


def running_totals(cells: DataFrame, by: list[str], order: str, sums: list[str],
                   per_task: int = CELLS_PER_TASK, range_col: Column | None = None) -> DataFrame:
    """Add ``<s>_before`` (exclusive running sum) and ``<s>_total`` for each of ``sums``.

    ``cells`` must be staged (it is scanned more than once) and hold one row per
    (by, order).  Up to ``per_task`` counted cells a plain window per group does
    it.  Beyond that ``order`` is cut into ranges of about ``per_task`` cells, at
    approximate quantiles: where exactly the cuts fall has no effect on the result.
    """
    n = cells.count()
    w = Window.partitionBy(*by)
    if n <= per_task:
        before = w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return cells.select(
            "*",
            *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_before") for s in sums],
            *[F.sum(s).over(w).alias(f"{s}_total") for s in sums],
        )
    if range_col is None:
        ranged = _with_value_range(cells, order, min(MAX_RANGES, n // per_task + 1))
    else:
        ranged = cells.withColumn("_range", range_col)
    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    before = w.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # At most MAX_RANGES rows a group here.
    offsets = stage(totals.select(
        *by, "_range",
        *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(w).alias(f"{s}_total") for s in sums],
    ), "offsets")
    local = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.select("*", *[F.coalesce(F.sum(s).over(local), F.lit(0)).alias(f"_l_{s}") for s in sums])
    joined = join_small(inside, offsets, [*by, "_range"])
    return joined.select(
        *cells.columns,
        *[(F.col(f"_l_{s}") + F.col(f"_o_{s}")).alias(f"{s}_before") for s in sums],
        *[F.col(f"{s}_total") for s in sums],
    )


def value_cells(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Staged (by, value, n): the distinct values of each group with their counts."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    return stage(counted, "cells")


def group_quantiles(df: DataFrame, by: list[str], value: str, probs: list[float],
                    per_task: int = CELLS_PER_TASK) -> DataFrame:
    """Exact quantiles of ``value`` in each group: (by..., q array<double>).

    The p-quantile is the smallest value whose cumulative share reaches p.
    """
    return quantiles_of(running_totals(value_cells(df, by, value), by, value, ["n"], per_task), by, value, probs)


def quantiles_of(totals: DataFrame, by: list[str], value: str, probs: list[float]) -> DataFrame:
    """``group_quantiles`` from running totals of the number of rows.

    A cell answers p when the p-th row of its group falls inside the cell.
    """
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.greatest(F.ceil(F.lit(p) * F.col("n_total")), F.lit(1)).alias("k"))
                       for i, p in enumerate(probs)])
    hits = totals.select(*by, F.col(value).cast("double").alias("_v"), "n", "n_before",
                         F.explode(F.filter(wanted, lambda s: (s["k"] > F.col("n_before"))
                                            & (s["k"] <= F.col("n_before") + F.col("n")))).alias("_s"))
    picked = [F.max(F.when(F.col("_s.i") == i, F.col("_v"))) for i in range(len(probs))]
    return hits.groupBy(*by).agg(F.array(*picked).alias("q"))


def tie_order(ids: list[str], seed: int = 0) -> Column:
    """Uniform order among equal scores, fixed by the row's unique key."""
    return F.struct(hash28(*ids, seed=seed).alias("h"), *[F.col(i) for i in ids])


def rank_in_ties(rows: DataFrame, by: list[str], ids: list[str], per_task: int = CELLS_PER_TASK,
                 seed: int = 0) -> DataFrame:
    """0-based rank of each row among the rows of its group, ordered by key hash, then key.

    The hash is uniform, so cutting its span in equal ranges gives equal tasks
    even when one group holds most rows.
    """
    staged = stage(rows.withColumn("_one", F.lit(1).cast("bigint")).withColumn("_tie", tie_order(ids, seed)), "ties")
    ranges = min(MAX_RANGES, staged.count() // per_task + 1)
    range_col = F.floor(F.col("_tie.h") * F.lit(ranges) / F.lit(HASH_SPAN)).cast("int")
    ranked = running_totals(staged, by, "_tie", ["_one"], per_task, range_col)
    return ranked.withColumnRenamed("_one_before", "tie_rank").drop("_one", "_one_total", "_tie")


def row_positions(df: DataFrame, by: list[str], order: list[str], out: str, per_task: int = CELLS_PER_TASK) -> DataFrame:
    """0-based position of each row in its group, for any sortable columns that order it uniquely.

    ``df`` must be staged.  Above ``per_task`` rows they are range-partitioned
    and sorted, and the place of a row is its place in its partition plus the
    sizes of the partitions before it.  The sorted rows are written with their
    places, so that partition bounds drawn anew by a retry cannot disagree.
    """
    n = df.count()
    if n <= per_task:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)
    parts = min(MAX_RANGES, n // per_task + 1)
    ordered = df.repartitionByRange(parts, *by, *order).sortWithinPartitions(*by, *order)
    placed = stage(ordered.withColumn("_id", F.monotonically_increasing_id()), "sorted").withColumns({
        "_part": F.shiftright("_id", 33), "_pos": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # At most MAX_RANGES rows.
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "offsets")
    rows = join_small(placed, offsets, ["_part"]).withColumn("_at", F.col("_before") + F.col("_pos"))
    starts = stage(rows.groupBy(*by).agg(F.min("_at").alias("_start")), "starts")
    return join_small(rows, starts, by).select(*df.columns, (F.col("_at") - F.col("_start")).cast("int").alias(out))
