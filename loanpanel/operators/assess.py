"""Tables to judge a model by: curves, KS, deciles, segments, marginals, R-squared.

Every table is computed per level of a slicer; ``no_groups`` gives the overall
one.  Input rows carry ``fit`` and ``obs`` (see ``coalesce_target``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanpanel.operators.network import coalesce_target
from loanpanel.operators.running import CELLS_PER_TASK, group_quantiles, rank_in_ties, running_totals
from loanpanel.operators.sampling import LEVEL_SEED, sample_per_level
from loanpanel.sources.tables import BROADCAST_ROWS, join_small, stage

OVERALL = "no_groups"
CUTS = [0.1, 0.25, 0.5, 0.75, 0.9]
GROUP_NAMES = ["<.1", ".1-.25", ".25-.5", ".5-.75", ".75-.9", ">.9"]
Z95 = 1.96
GRID = 10
TOP_LEVELS = 10
MARGINAL_ROWS = 10_000


def _sliced(df: DataFrame, by: str | None) -> DataFrame:
    """Rows with their slice value as text in ``slice``."""
    return df.withColumn("slice", F.lit("Overall") if by in (None, OVERALL) else F.col(by).cast("string"))


def quantile_group(value: Column, cuts: Column) -> Column:
    """1..6: how many of the five cuts the value exceeds, plus one."""
    above = [F.when(value > cuts[i], 1).otherwise(0) for i in range(len(CUTS))]
    return F.when(value.isNotNull(), F.lit(1) + above[0] + above[1] + above[2] + above[3] + above[4])


def group_name(group: Column) -> Column:
    # As a CASE: inside explode(array(struct(...))) a NULL index of element_at was read as -1, the last name.
    named = F.when(group == 1, GROUP_NAMES[0])
    for k, name in enumerate(GROUP_NAMES[1:], 2):
        named = named.when(group == k, name)
    return named


def with_quantile_group(df: DataFrame, by: list[str], value: str, out: str,
                        per_task: int = CELLS_PER_TASK) -> DataFrame:
    """Add the quantile group of ``value`` within its ``by`` group."""
    cuts = stage(group_quantiles(df, by, value, CUTS, per_task), "cuts")
    joined = join_small(df, cuts, by, "left")
    return joined.withColumn(out, quantile_group(F.col(value).cast("double"), F.col("q"))).drop("q")


def _averages() -> list[Column]:
    half = F.lit(Z95) * F.stddev_samp("obs") / F.sqrt(F.count(F.lit(1)).cast("double"))
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg("fit").alias("avg_fit"),
        F.avg("obs").alias("avg_obs"),
        (F.avg("obs") - half).alias("low"),
        (F.avg("obs") + half).alias("high"),
    ]


def curves(df: DataFrame, slicer: str, continuous: bool = False, per_task: int = CELLS_PER_TASK) -> DataFrame:
    """Average observed and fitted by level of ``slicer``; a continuous one is cut in six groups."""
    if continuous:
        rows = df.withColumn("_all", F.lit("Overall"))
        grouped = with_quantile_group(rows, ["_all"], slicer, "_g", per_task)
        level = group_name(F.col("_g"))
    else:
        grouped, level = df, F.col(slicer).cast("string")
    return grouped.groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("fit").alias("avg_fit"), F.avg("obs").alias("avg_obs"))


def score_cells(df: DataFrame, by: str | None = None) -> DataFrame:
    """Staged (slice, fit) cells with row counts and sums of the observed value."""
    cells = _sliced(df, by).groupBy("slice", "fit").agg(
        F.count(F.lit(1)).alias("n"), F.sum("obs").alias("s_obs"), F.sum(F.col("obs") * F.col("obs")).alias("s_obs2"))
    return stage(cells, "cells")


def class_cdfs(df: DataFrame, by: str | None = None, per_task: int = CELLS_PER_TASK,
               cells: DataFrame | None = None) -> DataFrame:
    """Score CDFs of observed 1 and 0 at every distinct score of a slice."""
    cells = score_cells(df, by) if cells is None else cells
    ones = cells.select("slice", "fit", F.col("s_obs").cast("bigint").alias("n1"),
                        (F.col("n") - F.col("s_obs").cast("bigint")).alias("n0"))
    run = running_totals(ones, ["slice"], "fit", ["n0", "n1"], per_task)

    def cdf(c: str) -> Column:
        return F.try_divide(F.col(f"{c}_before") + F.col(c), F.col(f"{c}_total"))

    return run.select("slice", "fit", "n0_total", "n1_total", cdf("n0").alias("cdf0"), cdf("n1").alias("cdf1"))


def ks(df: DataFrame, by: str | None = None, per_task: int = CELLS_PER_TASK,
       cells: DataFrame | None = None) -> DataFrame:
    """Largest distance between the two score CDFs, in percent, per slice."""
    return class_cdfs(df, by, per_task, cells).groupBy("slice").agg(
        (100.0 * F.max(F.abs(F.col("cdf1") - F.col("cdf0")))).alias("ks"),
        F.max("n0_total").alias("n0"), F.max("n1_total").alias("n1"))


def tile(rank0: Column, n: Column, tiles: int = 10) -> Column:
    """1..tiles of the 0-based rank; the first n % tiles groups have one row more."""
    size, extra = F.floor(n / F.lit(tiles)), n % F.lit(tiles)
    big = extra * (size + 1)
    # size is 0 only when all rows sit in the first branch.
    return F.when(rank0 < big, F.floor(rank0 / (size + 1)) + 1).otherwise(
        extra + F.floor((rank0 - big) / F.greatest(size, F.lit(1))) + 1).cast("int")


def decile(df: DataFrame, ids: list[str], by: str | None = None, per_task: int = CELLS_PER_TASK,
           cells: DataFrame | None = None) -> DataFrame:
    """Ten equal groups by model output: averages, a 95% interval and n, per slice.

    Cells of equal score that fall inside one group add their sums as they are.
    A cell that straddles a boundary (at most nine per slice) sends its rows to
    be split in the order of ``ids``, however many rows share that score.
    """
    cells = score_cells(df, by) if cells is None else cells
    run = running_totals(cells, ["slice"], "fit", ["n"], per_task)
    ranked = run.withColumns({
        "lo": tile(F.col("n_before"), F.col("n_total")),
        "hi": tile(F.col("n_before") + F.col("n") - 1, F.col("n_total")),
    })
    ranked = stage(ranked, "ranked")
    whole = ranked.where("lo = hi").select(
        "slice", F.col("lo").alias("decile"), "n", (F.col("fit") * F.col("n")).alias("s_fit"), "s_obs", "s_obs2")
    straddling = ranked.where("lo < hi").select("slice", "fit", "n_before", "n_total")
    parts = whole
    if not straddling.isEmpty():
        rows = _sliced(df, by).select("slice", "fit", "obs", *[i for i in ids])
        # At most nine rows per slice on the small side.
        rows = join_small(rows, stage(straddling, "straddling"), ["slice", "fit"])
        split = rank_in_ties(rows, ["slice", "fit"], ids, per_task)
        place = tile(F.col("n_before") + F.col("tie_rank"), F.col("n_total"))
        parts = whole.unionByName(split.select(
            "slice", place.alias("decile"), F.lit(1).cast("bigint").alias("n"), F.col("fit").alias("s_fit"),
            F.col("obs").alias("s_obs"), (F.col("obs") * F.col("obs")).alias("s_obs2")))
    sums = parts.groupBy("slice", "decile").agg(*[F.sum(c).alias(c) for c in ("n", "s_fit", "s_obs", "s_obs2")])
    mean = F.col("s_obs") / F.col("n")
    var = F.try_divide(F.greatest(F.col("s_obs2") - F.col("n") * mean * mean, F.lit(0.0)), F.col("n") - 1)
    half = F.lit(Z95) * F.sqrt(var / F.col("n"))
    return sums.select("slice", "decile", "n", (F.col("s_fit") / F.col("n")).alias("avg_fit"), mean.alias("avg_obs"),
                       (mean - half).alias("low"), (mean + half).alias("high"))


def segment(df: DataFrame, categorical: list[str], continuous: list[str] = (), by: str | None = None,
            per_task: int = CELLS_PER_TASK) -> DataFrame:
    """Averages per level of every listed feature, per slice.

    Continuous features are cut in six quantile groups within the slice.  All
    features are unpivoted together: one pass for the quantiles, one for the averages.
    """
    rows = _sliced(df, by)
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("segment")) for c in categorical]
    if continuous:
        values = rows.select("slice", F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in continuous])).alias("s"))
        cuts = group_quantiles(values.select("slice", "s.*"), ["slice", "feature"], "value", CUTS, per_task)
        per_slice = stage(cuts.groupBy("slice").agg(F.map_from_entries(
            F.collect_list(F.struct("feature", "q"))).alias("cuts")), "cuts")  # one entry per listed feature
        rows = join_small(rows, per_slice, ["slice"], "left", BROADCAST_ROWS // len(continuous))  # a row has the cuts of all
        entries += [F.struct(F.lit(c).alias("feature"), group_name(
            quantile_group(F.col(c).cast("double"), F.col("cuts")[c])).alias("segment")) for c in continuous]
    long = rows.select("slice", "fit", "obs", F.explode(F.array(*entries)).alias("s"))
    return long.groupBy("slice", F.col("s.feature").alias("feature"), F.col("s.segment").alias("segment")).agg(
        *_averages())


def axis_range(df: DataFrame, by: str | None = None, per_task: int = CELLS_PER_TASK) -> DataFrame:
    """Common plot range of fit and obs per slice: their 10% and 90% quantiles."""
    long = _sliced(df, by).select("slice", F.explode(F.array(
        F.struct(F.lit("fit").alias("of"), F.col("fit").alias("value")),
        F.struct(F.lit("obs").alias("of"), F.col("obs").alias("value")))).alias("s")).select("slice", "s.*")
    q = group_quantiles(long, ["slice", "of"], "value", [0.1, 0.9], per_task)
    return q.groupBy("slice").agg(F.min(F.col("q")[0]).alias("low"), F.max(F.col("q")[1]).alias("high"))


def summary(df: DataFrame, value: str, by: str | None = None, per_task: int = CELLS_PER_TASK) -> DataFrame:
    """Mean, deviation and quantile grid of a column per slice."""
    rows = _sliced(df, by)
    moments = rows.groupBy("slice").agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"),
        F.min(value).cast("double").alias("min"), F.max(value).cast("double").alias("max"))
    q = stage(group_quantiles(rows, ["slice"], value, CUTS, per_task), "grid")
    named = q.select("slice", *[F.col("q")[i].alias(f"q{round(p * 100)}") for i, p in enumerate(CUTS)])
    return join_small(moments, named, ["slice"], "left")


def r_squared(df: DataFrame, by: str | None = None) -> DataFrame:
    """Percent of the variance of ``obs`` explained by ``fit``."""
    miss = F.col("obs") - F.col("fit")
    return _sliced(df, by).groupBy("slice").agg(
        F.count(F.lit(1)).alias("n"),
        (100.0 * (1.0 - F.try_divide(F.avg(miss * miss), F.var_pop("obs")))).alias("r2"))


def marginal_groups(df: DataFrame, by: str | None, ids: list[str], n: int = MARGINAL_ROWS, seed: int = LEVEL_SEED,
                    per_task: int = CELLS_PER_TASK) -> DataFrame:
    """Staged sample of ``n`` rows per slice with ``grp``: 1 the highest model output, 6 the lowest."""
    sample = stage(sample_per_level(_sliced(df, by), ["slice"], n, ids, seed), "marginal")
    grouped = with_quantile_group(sample, ["slice"], "fit", "_g", per_task)
    return stage(grouped.withColumn("grp", F.lit(7) - F.col("_g")).drop("_g"), "marginal-groups")


def marginal_distribution(groups: DataFrame, feature: str, continuous: bool) -> DataFrame:
    """Distribution of the feature in each output group: five numbers, or counts per level.

    Groups hold at most the per-slice sample, so exact percentiles are bounded.
    """
    keyed = groups.groupBy("slice", "grp") if continuous else groups.groupBy(
        "slice", "grp", F.col(feature).cast("string").alias("level"))
    if not continuous:
        return keyed.agg(F.count(F.lit(1)).alias("n"))
    q = F.percentile(F.col(feature).cast("double"), F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    five = keyed.agg(F.count(F.lit(1)).alias("n"), q.alias("q"))
    return five.select("slice", "grp", "n", *[F.col("q")[i].alias(m) for i, m in
                                              enumerate(("min", "q25", "median", "q75", "max"))])


def feature_grid(groups: DataFrame, feature: str, continuous: bool) -> DataFrame:
    """(slice, grp, grid): the values a feature is moved to within each output group.

    Continuous: evenly spaced from its 10% to its 90% quantile.  Categorical:
    its ten most frequent levels.
    """
    if continuous:
        ends = F.percentile(F.col(feature).cast("double"), F.array(F.lit(0.1), F.lit(0.9)))
        q = groups.groupBy("slice", "grp").agg(ends.alias("q"))
        lo, hi = F.col("q")[0], F.col("q")[1]
        steps = F.array(*[lo + (hi - lo) * F.lit(i / (GRID - 1)) for i in range(GRID)])
        return q.select("slice", "grp", F.array_distinct(steps).alias("grid"))
    # One entry per level seen in a bounded sample.
    counts = groups.groupBy("slice", "grp", F.col(feature)).agg(F.count(F.lit(1)).alias("n"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col(feature).alias("v"))))
    top = counts.groupBy("slice", "grp").agg(F.slice(ranked, 1, TOP_LEVELS).alias("t"))
    return top.select("slice", "grp", F.col("t.v").alias("grid"))


def marginal(df: DataFrame, feature: str, by: str | None, scorer: Callable[[DataFrame], DataFrame],
             target_cols: list[int], ids: list[str], continuous: bool, n: int = MARGINAL_ROWS, seed: int = LEVEL_SEED,
             groups: DataFrame | None = None, view=coalesce_target) -> tuple[DataFrame, DataFrame]:
    """(response, distribution) of one feature, per slice and output group.

    Sampled rows take each grid value of their group in turn, are scored again
    with ``scorer`` (which adds ``probs``), and the new outputs are summarised.
    """
    groups = marginal_groups(df, by, ids, n, seed) if groups is None else groups
    grid = stage(feature_grid(groups, feature, continuous), "grid")
    moved = join_small(groups, grid, ["slice", "grp"]).withColumn("at", F.explode("grid")).drop("grid")
    rescored = view(scorer(moved.withColumn(feature, F.col("at"))), target_cols)
    q = F.percentile("fit", F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    five = rescored.groupBy("slice", "grp", "at").agg(F.count(F.lit(1)).alias("n"), q.alias("q"))
    response = five.select("slice", "grp", "at", "n", *[F.col("q")[i].alias(m) for i, m in
                                                        enumerate(("min", "q25", "median", "q75", "max"))])
    return response, marginal_distribution(groups, feature, continuous)
