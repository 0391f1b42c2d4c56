"""All tables of an assessment at once.

Every (title, slicer) pair is a set.  One pass over the scored rows counts the cells of all sets: how many rows of a slice have a value, of
the model output, of the observed target and of each continuous feature.  The overall cells are the sliced ones added up.  One run
of prefix sums over (set, slice) then gives KS, deciles, plot ranges and the quantile groups, and a second pass over the rows the
averages of all segments and curves.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanpanel.operators.assess import (
    CUTS,
    OVERALL,
    Z95,
    _averages,
    group_name,
    marginal,
    marginal_groups,
    quantile_group,
    tile,
)
from loanpanel.operators.network import coalesce_target
from loanpanel.operators.running import CELLS_PER_TASK, quantiles_of, rank_in_ties, running_totals
from loanpanel.sources.tables import BROADCAST_ROWS, join_small, stage

FIT, OBS, FIRST_FEATURE = 0, 1, 2  # what the values of a cell are of
KEYS = ["set", "overall", "slice"]


@dataclass
class Set:
    """One (title, slicer) pair, or one curve."""

    number: int
    title: str
    view: int  # which fit and obs columns
    slicer: str  # OVERALL for none
    features: list[str]  # averaged by their levels
    is_curve: bool = False

    @property
    def slice(self) -> Column:
        return F.lit("Overall") if self.slicer == OVERALL else F.col(self.slicer).cast("string")


def _viewed(df: DataFrame, views: list[tuple[int, ...]], view) -> DataFrame:
    """``_fit<v>`` and ``_obs<v>`` of each distinct list of output columns."""
    for v, cols in enumerate(views):
        df = view(df, list(cols)).withColumnsRenamed({"fit": f"_fit{v}", "obs": f"_obs{v}"})
    return df


def _entry(of: Set, what: int, value: Column, obs: Column) -> Column:
    return F.struct(F.lit(of.number).alias("set"), of.slice.alias("slice"), F.lit(what).alias("of"),
                    value.cast("double").alias("value"), obs.cast("double").alias("obs"))


def cell_table(rows: DataFrame, sets: list[Set], continuous: list[str], centres: list[float]) -> DataFrame:
    """Staged cells ``set, overall, slice, of, value, n, n1, s1, s2`` of all sets.

    ``n1`` adds the observed values, ``s1`` and ``s2`` their distances from a centre near their mean and the squares of these, so that
    no variance is the difference of two large numbers.
    """
    entries, none = [], F.lit(None)
    for s in sets:
        if not s.is_curve:
            fit, obs = F.col(f"_fit{s.view}"), F.col(f"_obs{s.view}")
            entries += [_entry(s, FIT, fit, obs), _entry(s, OBS, obs, none)]
        entries += [_entry(s, FIRST_FEATURE + k, F.col(c), none) for k, c in enumerate(continuous) if c in s.features]
    long = rows.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where("value IS NOT NULL")
    by_set = {s.number: centres[s.view] for s in sets}
    centre = F.element_at(F.create_map(*[F.lit(x) for pair in by_set.items() for x in pair]), F.col("set"))
    away = F.col("obs") - centre
    sliced = stage(long.groupBy("set", "slice", "of", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("obs").alias("n1"), F.sum(away).alias("s1"), F.sum(away * away).alias("s2")), "cells")
    also_overall = [s.number for s in sets if not s.is_curve and s.slicer != OVERALL]
    rolled = sliced.where((F.col("of") == FIT) & F.col("set").isin(also_overall)).groupBy("set", "of", "value").agg(
        *[F.sum(c).alias(c) for c in ("n", "n1", "s1", "s2")])
    columns = [*KEYS, "of", "value", "n", "n1", "s1", "s2"]
    whole = rolled.withColumns({"overall": F.lit(True), "slice": F.lit("Overall")}).select(*columns)
    # A set without a slicer has its overall cells already.
    flagged = sliced.withColumn("overall", F.col("set").isin([s.number for s in sets if s.slicer == OVERALL])).select(*columns)
    return stage(flagged.unionByName(whole), "all-cells")


def ks_table(ranked: DataFrame) -> DataFrame:
    """``set, overall, slice, ks, n0, n1`` from running totals."""
    n0, n0_before, n0_total = (F.col(a) - F.col(b) for a, b in (("n", "n1"), ("n_before", "n1_before"), ("n_total", "n1_total")))
    gap = F.try_divide(F.col("n1_before") + F.col("n1"), F.col("n1_total")) - F.try_divide(n0_before + n0, n0_total)
    return ranked.where(F.col("of") == FIT).groupBy(*KEYS).agg(
        (100.0 * F.max(F.abs(gap))).alias("ks"), F.max(n0_total).cast("bigint").alias("n0"),
        F.max("n1_total").cast("bigint").alias("n1"))


def decile_table(ranked: DataFrame, rows: DataFrame, sets: list[Set], ids: list[str], centres: list[float],
                 per_task: int = CELLS_PER_TASK) -> DataFrame:
    """``set, overall, slice, decile, n, avg_fit, avg_obs, low, high``; see ``assess.decile``."""
    placed = ranked.where(F.col("of") == FIT).withColumns({
        "lo": tile(F.col("n_before"), F.col("n_total")), "hi": tile(F.col("n_before") + F.col("n") - 1, F.col("n_total"))})
    parts = placed.where("lo = hi").select(
        *KEYS, F.col("lo").alias("decile"), "n", (F.col("value") * F.col("n")).alias("s_fit"), "s1", "s2")
    straddling = stage(placed.where("lo < hi").select(*KEYS, "value", "n_before", "n_total"), "straddling")
    centre = F.element_at(F.create_map(*[F.lit(x) for s in sets for x in (s.number, centres[s.view])]), F.col("set"))
    if not straddling.isEmpty():
        # At most nine cells of a slice; their rows are split in the order of the ids.
        entries = []
        for s in sets:
            for overall in {True, s.slicer == OVERALL}:
                if not s.is_curve:
                    entries.append(F.struct(
                        F.lit(s.number).alias("set"), F.lit(overall).alias("overall"),
                        (F.lit("Overall") if overall else s.slice).alias("slice"),
                        F.col(f"_fit{s.view}").cast("double").alias("value"), F.col(f"_obs{s.view}").cast("double").alias("obs")))
        long = rows.select(*[F.col(i).alias(f"_id{k}") for k, i in enumerate(ids)], F.explode(F.array(*entries)).alias("e"))
        hit = join_small(long.select("e.*", *[f"_id{k}" for k in range(len(ids))]), straddling, [*KEYS, "value"])
        split = rank_in_ties(hit, [*KEYS, "value"], [f"_id{k}" for k in range(len(ids))], per_task)
        away = F.col("obs") - centre
        parts = parts.unionByName(split.select(
            *KEYS, tile(F.col("n_before") + F.col("tie_rank"), F.col("n_total")).alias("decile"), F.lit(1).cast("bigint").alias("n"),
            F.col("value").alias("s_fit"), away.alias("s1"), (away * away).alias("s2")))
    sums = parts.groupBy(*KEYS, "decile").agg(*[F.sum(c).alias(c) for c in ("n", "s_fit", "s1", "s2")])
    shift = F.col("s1") / F.col("n")
    var = F.try_divide(F.greatest(F.col("s2") - F.col("n") * shift * shift, F.lit(0.0)), F.col("n") - 1)
    half, mean = F.lit(Z95) * F.sqrt(var / F.col("n")), centre + shift
    return sums.select(*KEYS, "decile", "n", (F.col("s_fit") / F.col("n")).alias("avg_fit"), mean.alias("avg_obs"),
                       (mean - half).alias("low"), (mean + half).alias("high"))


def average_table(rows: DataFrame, ranked: DataFrame, sets: list[Set], categorical: list[str], continuous: list[str]) -> DataFrame:
    """``set, slice, feature, segment`` and averages, of all segments and curves; continuous features in their quantile groups."""
    per_set = rows.select("*", F.explode(F.array(*[F.struct(
        F.lit(s.number).alias("set"), s.slice.alias("slice"), F.col(f"_fit{s.view}").cast("double").alias("fit"),
        F.col(f"_obs{s.view}").cast("double").alias("obs")) for s in sets])).alias("_e"))
    per_set = per_set.select("_e.*", *dict.fromkeys(c for s in sets for c in s.features))
    asked = {c for s in sets for c in s.features}
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("segment")) for c in categorical if c in asked]
    used = [(k, c) for k, c in enumerate(continuous) if c in asked]
    if used:
        by = ["set", "slice", "of"]
        cuts = quantiles_of(ranked.where(F.col("of") >= FIRST_FEATURE), by, "value", CUTS)
        per_slice = stage(cuts.groupBy("set", "slice").agg(F.map_from_entries(
            F.collect_list(F.struct("of", "q"))).alias("cuts")), "cuts")  # one entry per feature
        per_set = join_small(per_set, per_slice, ["set", "slice"], "left", BROADCAST_ROWS // len(used))
        entries += [F.struct(F.lit(c).alias("feature"), group_name(quantile_group(
            F.col(c).cast("double"), F.col("cuts")[FIRST_FEATURE + k])).alias("segment")) for k, c in used]
    own = F.element_at(F.create_map(*[x for s in sets for x in (F.lit(s.number), F.array(*[F.lit(c) for c in s.features]))]),
                       F.col("set"))
    long = per_set.select("set", "slice", "fit", "obs", F.explode(F.filter(
        F.array(*entries), lambda e: F.array_contains(own, e["feature"]))).alias("s"))
    return long.groupBy("set", "slice", F.col("s.feature").alias("feature"), F.col("s.segment").alias("segment")).agg(*_averages())


def range_table(ranked: DataFrame) -> DataFrame:
    """``set, slice, low, high``: the 10% and 90% quantiles of fit and obs together."""
    q = quantiles_of(ranked.where(F.col("of").isin(FIT, OBS)), [*KEYS, "of"], "value", [0.1, 0.9])
    return q.groupBy(*KEYS).agg(F.min(F.col("q")[0]).alias("low"), F.max(F.col("q")[1]).alias("high"))


def r2_table(rows: DataFrame, sets: list[Set]) -> DataFrame:
    """``set, overall, slice, n, r2`` of all sets."""
    entries = [F.struct(F.lit(s.number).alias("set"), F.lit(overall).alias("overall"),
                        (F.lit("Overall") if overall else s.slice).alias("slice"),
                        F.col(f"_fit{s.view}").alias("fit"), F.col(f"_obs{s.view}").alias("obs"))
               for s in sets if not s.is_curve for overall in {True, s.slicer == OVERALL}]
    miss = F.col("obs") - F.col("fit")
    return rows.select(F.explode(F.array(*entries)).alias("e")).select("e.*").groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), (100.0 * (1.0 - F.try_divide(F.avg(miss * miss), F.var_pop("obs")))).alias("r2"))


def _sets(specs, curve_specs, views, categorical: list[str], continuous: list[str]) -> list[Set]:
    out = []
    for title, cols, slicer in specs:
        features = [c for c in dict.fromkeys([*categorical, *continuous]) if c != slicer]
        out.append(Set(len(out), title, views.index(tuple(cols)), slicer, features))
    for title, cols, slicer in curve_specs:
        out.append(Set(len(out), title, views.index(tuple(cols)), OVERALL, [slicer], True))
    return out


def assess_all(df: DataFrame, specs: list[tuple[str, list[int], str]], ids: list[str], categorical: list[str],
               continuous: list[str], curve_specs: list[tuple[str, list[int], str]] = (),
               view: Callable[[DataFrame, list[int]], DataFrame] = coalesce_target,
               regression: bool = False, scorer=None, per_task: int = CELLS_PER_TASK) -> dict[str, DataFrame]:
    """All tables of a job from one scored table, which should be staged: it is scanned three times.

    ``specs`` and ``curve_specs`` are (title, output columns, slicer).
    """
    for _, _, slicer in specs:
        if slicer != OVERALL and slicer in continuous:
            raise ValueError(f"cannot slice on continuous feature {slicer}")
    if not specs and not curve_specs:
        return {}
    views = list(dict.fromkeys(tuple(cols) for _, cols, _ in [*specs, *curve_specs]))
    sets = _sets(specs, curve_specs, views, categorical, continuous)
    levels = list(dict.fromkeys([*categorical, *[s for _, _, s in curve_specs if s not in continuous]]))
    rows = _viewed(df, views, view).withColumn(OVERALL, F.lit("Overall"))
    # Sums of 0 and 1 are exact as they are; a continuous target is centred.
    centres = [float(m or 0.0) for m in rows.agg(*[F.avg(f"_obs{v}") for v in range(len(views))]).first()] \
        if regression else [0.0] * len(views)
    cells = cell_table(rows, sets, continuous, centres)
    ranked = stage(running_totals(cells, [*KEYS, "of"], "value", ["n", "n1"], per_task), "ranked")
    deciles = stage(decile_table(ranked, rows, sets, ids, centres, per_task), "deciles")
    averages = stage(average_table(rows, ranked, sets, levels, continuous), "averages")
    ranges = stage(range_table(ranked), "ranges")
    fits = stage(r2_table(rows, sets) if regression else ks_table(ranked), "fits")

    def of(table: DataFrame, s: Set, overall: bool) -> DataFrame:
        return table.where((F.col("set") == s.number) & (F.col("overall") == overall)).drop("set", "overall")

    out: dict[str, DataFrame] = {}
    for s in sets:
        own = averages.where(F.col("set") == s.number).drop("set")
        if s.is_curve:
            out[f"{s.title}/curves"] = own.select(F.col("segment").alias("level"), "n", "avg_fit", "avg_obs")
            continue
        for label in ("overall", *["sliced"] * (s.slicer != OVERALL)):
            out[f"{s.title}/{label}/{'r2' if regression else 'ks'}"] = of(fits, s, label == "overall")
            out[f"{s.title}/{label}/decile"] = of(deciles, s, label == "overall")
        out[f"{s.title}/segment"] = own
        out[f"{s.title}/range"] = of(ranges, s, s.slicer == OVERALL)
        if scorer is not None:
            judged = rows.withColumnsRenamed({f"_fit{s.view}": "fit", f"_obs{s.view}": "obs"})
            groups = marginal_groups(judged, s.slicer, ids)
            cols = list(views[s.view])
            for f in [*categorical, *continuous]:
                response, spread = marginal(judged, f, s.slicer, scorer, cols, ids, f in continuous, groups=groups, view=view)
                out[f"{s.title}/marginal/{f}"], out[f"{s.title}/marginal/{f}/distribution"] = response, spread
    return out
