"""Stratified and simple random sampling, reproducible from a hash of the row key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanpanel.functions.expr import NO_BOUND, as_predicate, digest_bound, hash28, key_digest
from loanpanel.operators.running import row_positions
from loanpanel.sources.tables import BROADCAST_ROWS, join_small, stage

SEED = 10
LEVEL_SEED = 11  # samples per level hash another text, so that a sample of a sample does not follow the first draw
GROUP_ROWS = 1_000_000  # a boundary group above this is refined once more before it is ranked


def strata_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows per joint level of ``cols``."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def balanced_cap(counts: DataFrame, target_n: int) -> float | None:
    """The cap c with sum(min(n_h, c)) = target_n; None when all rows are needed.

    Works on the histogram of stratum sizes.  N rows have fewer than sqrt(2N)
    different stratum sizes (1 + 2 + ... + k <= N), under half a million for
    1e11 rows, so the histogram fits the driver whatever the strata are.
    """
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("groups")).collect()
    sizes = sorted((r["n"], r["groups"]) for r in sizes)
    taken, left = 0, sum(g for _, g in sizes)
    for n, groups in sizes:
        cap = (target_n - taken) / left
        if cap <= n:
            return cap
        taken += n * groups
        left -= groups
    return None


def strata_rates(df: DataFrame, cols: list[str], target_n: int, counts: DataFrame | None = None) -> DataFrame:
    """Strata table: count, sampling rate and expected sample of each joint level.

    Equal takes from every stratum, up to its size, that add to ``target_n``.
    The counts are staged, so the wide source is scanned once for them.
    """
    counts = stage(strata_counts(df, cols) if counts is None else counts, "strata")
    cap = balanced_cap(counts, target_n)
    rate = F.lit(1.0) if cap is None else F.least(F.lit(1.0), F.lit(float(cap)) / F.col("n"))
    return counts.select(*cols, "n", rate.alias("rate")).withColumn("expected", F.col("rate") * F.col("n"))


def exact_takes(rates: DataFrame, cols: list[str], seed: int = SEED) -> DataFrame:
    """Whole rows to take of each stratum, adding to the rounded sum of the expected ones.

    Every stratum gives the whole part of its expectation; the rest is made up
    by one more row from the strata of lowest hash that have one left.
    """
    whole = F.floor(F.round(F.col("rate") * F.col("n"), 6)).cast("bigint")
    base = stage(rates.select(*cols, "n", (F.col("rate") * F.col("n")).alias("_e"), whole.alias("_take")), "whole")
    expected, given = base.agg(F.sum("_e"), F.sum("_take")).first()
    more = round(expected or 0) - (given or 0)
    if more <= 0:
        return base.select(*cols, "_take")
    spare = base.where("_take < n").select(*cols, hash28(*cols, seed=seed).alias("_h"), F.lit(0).alias("_g"))
    placed = row_positions(stage(spare, "spare"), ["_g"], ["_h", *cols], "_at")
    added = stage(placed.where(F.col("_at") < more).select(*cols, F.lit(1).alias("_more")), "more")
    return join_small(base, added, cols, "left").select(
        *cols, (F.col("_take") + F.coalesce("_more", F.lit(0))).alias("_take"))


Widen = Callable[[DataFrame, list[str]], DataFrame]  # (rows, helper columns to carry along)


def narrowed(rows: DataFrame, where: Column | str | None, strata: list[str]) -> DataFrame | None:
    """``rows`` filtered, or None when the predicate or the strata need columns that are added later."""
    if not set(strata) <= set(rows.columns):
        return None
    cond = as_predicate(where)
    try:
        out = rows if cond is None else rows.where(cond)
        out.schema  # noqa: B018 - resolves the predicate
        return out
    except AnalysisException:
        return None


def stratified_sample(df: DataFrame, cols: list[str], target_n: int, keys: list[str], seed: int = SEED,
                      exact: bool = False, rates: DataFrame | None = None, widen: Widen | None = None) -> DataFrame:
    """Sample balanced over the joint levels of ``cols``.

    A row is kept when the hash of its unique key falls below its stratum's
    rate: no sort, no state, the same rows on every run.  ``exact=True`` takes a
    fixed number of rows of each stratum instead, those of lowest hash.
    ``widen`` adds columns that only the sampled rows need.
    """
    if exact:
        bins = hash_bins(df, cols, keys, seed)
        rates = strata_rates(df, cols, target_n, group_sizes(bins, cols)) if rates is None else rates
        return take_lowest_hash(df, cols, exact_takes(rates, cols, seed), keys, seed, bins=bins, widen=widen)
    rates = strata_rates(df, cols, target_n) if rates is None else rates
    if widen and rates.count() > BROADCAST_ROWS:
        # The join will shuffle, and unwidened rows may carry whole histories: widen, and let them go, first.
        df, widen = widen(df, []), None
    joined = join_small(df, rates.select(*cols, digest_bound(F.col("rate")).alias("_bound")), cols, sizes=rates)
    drawn = joined.where(key_digest(*keys, seed=seed) < F.col("_bound")).drop("_bound")
    return widen(drawn, []) if widen else drawn


def drawn_below(rows: DataFrame, cols: list[str], rates: DataFrame, digest: Column) -> DataFrame:
    """Rows whose key digest lies below the bound of their stratum: the draw of ``stratified_sample`` for rows of any number.

    ``rates`` is staged.  What lies above the highest bound, nearly every row, goes before it meets the rates.
    """
    bounds = rates.select(*cols, digest_bound(F.col("rate")).alias("_bound"))
    highest = bounds.agg(F.max("_bound")).first()[0]
    if highest is not None and highest < NO_BOUND:
        rows = rows.where(digest < F.lit(highest))
    return join_small(rows, bounds, cols, sizes=rates).where(digest < F.col("_bound")).drop("_bound")


def random_sample(df: DataFrame, target_n: int, keys: list[str], seed: int = SEED) -> DataFrame:
    """Simple random sample: one stratum, so the rate is one number and nothing is joined."""
    n = df.count()
    rate = min(1.0, target_n / n) if n else 1.0
    return df.where(key_digest(*keys, seed=seed) < digest_bound(F.lit(rate)))


def _with_bin(rows: DataFrame, shift: int) -> DataFrame:
    return rows.withColumn(f"_bin{shift}", F.shiftright("_h", shift).bitwiseAND(F.lit(4095)))


def _count_bins(rows: DataFrame, group: list[str], shift: int) -> DataFrame:
    return stage(rows.groupBy(*group, f"_bin{shift}").agg(F.count(F.lit(1)).alias("_m")), "bins")


def hash_bins(df: DataFrame, cols: list[str], keys: list[str], seed: int = SEED) -> DataFrame:
    """Staged rows per group and hash bin (the top 12 of 28 bits): at most 4,096 rows a group."""
    return _count_bins(_with_bin(df.withColumn("_h", hash28(*keys, seed=seed)), 16), cols, 16)


def group_sizes(bins: DataFrame, cols: list[str]) -> DataFrame:
    return bins.groupBy(*cols).agg(F.sum("_m").alias("n"))


def take_lowest_hash(df: DataFrame, cols: list[str], takes: DataFrame, keys: list[str], seed: int = SEED,
                     group_rows: int = GROUP_ROWS, bins: DataFrame | None = None,
                     widen: Widen | None = None) -> DataFrame:
    """Exactly ``_take`` rows of each group: those of lowest (hash, key).

    Counts per (group, hash bin) tell which bin holds the last wanted row.  Bins
    below it are kept whole, bins above it dropped, and only that bin is ranked:
    about 1/4,096 of a group.  If it is still above ``group_rows`` the next 12
    bits cut it again.  The source is scanned twice, once to count the bins and
    once to write the candidates.
    """
    bins = hash_bins(df, cols, keys, seed) if bins is None else bins
    hashed = _with_bin(df.withColumn("_h", hash28(*keys, seed=seed)), 16)
    group = [*cols, "_bin16"]
    takes = stage(takes, "takes")
    if widen and takes.count() > BROADCAST_ROWS:
        df, widen = widen(df, []), None  # see stratified_sample
        hashed = _with_bin(df.withColumn("_h", hash28(*keys, seed=seed)), 16)
    kept, edge, left = _split_at_boundary(hashed, bins, cols, takes, "_bin16", widen)
    columns = [c for c in kept.columns if c not in ("_h", "_bin16")]
    if (left.agg(F.max("_m")).first()[0] or 0) > group_rows:
        finer = _with_bin(edge, 4)
        more, edge, left = _split_at_boundary(finer, _count_bins(finer, group, 4), group, left.drop("_m"), "_bin4")
        kept = kept.unionByName(more.select(*kept.columns))
        group = [*group, "_bin4"]
    w = Window.partitionBy(*group).orderBy("_h", *keys)
    last = join_small(edge, left.drop("_m"), group).withColumn("_rn", F.row_number().over(w))
    return kept.select(*columns).unionByName(last.where("_rn <= _take").select(*columns))


def _split_at_boundary(rows: DataFrame, bins: DataFrame, group: list[str], takes: DataFrame, name: str,
                       widen: Widen | None = None):
    """Rows surely kept, rows of the boundary bins, and (group, bin, rows in it, rows still wanted)."""
    before = Window.partitionBy(*group).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
    run = bins.withColumn("_before", F.coalesce(F.sum("_m").over(before), F.lit(0)))
    run = join_small(run, takes, group)
    # One boundary row a group at most: none when nothing is wanted of it.
    cut = run.where((F.col("_before") < F.col("_take")) & (F.col("_before") + F.col("_m") >= F.col("_take")))
    left = stage(cut.select(*group, name, "_m", (F.col("_take") - F.col("_before")).alias("_take")), "boundary")
    joined = join_small(rows, left.select(*group, F.col(name).alias("_cut")), group)
    wanted = joined.where(F.col(name) <= F.col("_cut"))
    if widen:
        wanted = widen(wanted, ["_h", name, "_cut"])
    wanted = stage(wanted, "candidates")
    kept = wanted.where(F.col(name) < F.col("_cut")).drop("_cut")
    return kept, wanted.where(F.col(name) == F.col("_cut")).drop("_cut"), left


def sample_per_level(df: DataFrame, by: list[str], n: int, keys: list[str], seed: int = LEVEL_SEED) -> DataFrame:
    """``n`` random rows of every level of ``by`` (all of a level's rows when it has fewer).

    Independent of the strata draws, whose low hashes say nothing about this one's.
    """
    bins = hash_bins(df, by, keys, seed)
    takes = group_sizes(bins, by).select(*by, F.least(F.col("n"), F.lit(n)).cast("bigint").alias("_take"))
    return take_lowest_hash(df, by, takes, keys, seed, bins=bins)
