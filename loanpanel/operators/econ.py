"""Pass 3: economic data joined at several dates at once, and what follows from it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanpanel.functions.expr import level_payment, month_index, safe_div
from loanpanel.sources.tables import BROADCAST_ROWS, join_small, stage

BASE_MONTH = dt.date(2020, 1, 1)
ECON_COLUMNS = (
    "hpi", "unemp_rate", "lbr_force", "mort_fix30", "mort_fix15", "treas10", "income10", "income25", "income50",
    "income75", "income90", "fc_type", "fc_days",
)
DATES = {"trg": "trg_dt", "ao": "ao_dt", "org": "fp_dt"}
BASE = "y20"
MAX_RATIO = 1.5
GROWTH_CAP = 25.0
CALENDAR_ROWS = 1_000_000  # rows of the looked-up table that a task gathers


def rollup_econ(econ: DataFrame, geo: str = "zip3") -> DataFrame:
    """Geo x month table from a finer one; unemployment is weighted by labor force.

    Texts are keys of a first step, which reduces in hash tables: a maximum of texts sorts every row of the finer table.
    """
    texts = [c for c in ("msa_name", "state", "fc_type") if c not in (geo, "month")]
    largest = ("mort_fix30", "mort_fix15", "treas10", *[f"q{q}" for q in (10, 25, 50, 75, 90)], "fc_days")
    parts = econ.groupBy(geo, "month", *texts).agg(
        F.sum(F.col("zip3_hpi").cast("double")).alias("_hpi"), F.count("zip3_hpi").alias("_n_hpi"),
        F.sum(F.col("unemp_rate") * F.col("lbr_force")).alias("_weighted"), F.sum("lbr_force").alias("lbr_force"),
        *[F.max(c).alias(c) for c in largest])
    name = F.max("msa_name")
    return parts.groupBy(geo, "month").agg(
        F.try_divide(F.sum("_hpi"), F.sum("_n_hpi")).alias("hpi"),
        safe_div(F.sum("_weighted"), F.sum("lbr_force")).alias("unemp_rate"),
        F.sum("lbr_force").alias("lbr_force"),
        *[F.max(c).alias(c) for c in ("mort_fix30", "mort_fix15", "treas10")],
        *[F.max(f"q{q}").alias(f"income{q}") for q in (10, 25, 50, 75, 90)],
        F.when(name == "", F.max("state")).otherwise(name).alias("msa_name_loc"),
        F.max("fc_days").alias("fc_days"),
        F.max("fc_type").alias("fc_type"),
    )


def multi_date_join(df: DataFrame, ref: DataFrame, dates: dict[str, str], geo: str = "zip3", month: str = "month",
                    columns: tuple[str, ...] | None = None, how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Look ``ref`` up at (geo, date) for each ``{prefix: date column}``.

    ``ref`` is a staged table with one row per (geo, month).  When it is small
    enough to broadcast, the lookups are hash probes inside the scan of ``df``
    and share one broadcast.  Otherwise each geo's months are gathered in one row first and one shuffle join
    serves all dates.
    """
    columns = columns or tuple(c for c in ref.columns if c not in (geo, month))
    if (rows := ref.count()) > limit:
        return _by_geo_join(df, ref, dates, geo, month, columns, how, rows)
    lookup = ref.select(F.col(geo), F.col(month).alias("_date"), *columns)
    out = df
    for prefix, date_col in dates.items():
        before = out.columns
        renamed = out.withColumn("_date", F.col(date_col))
        values = lookup.select(geo, "_date", *[F.col(c).alias(f"{prefix}_{c}") for c in columns])
        out = join_small(renamed, values, [geo, "_date"], how, rows=0)  # counted above
        out = out.select(*before, *[f"{prefix}_{c}" for c in columns])
    return out


def _by_geo_join(df: DataFrame, ref: DataFrame, dates: dict[str, str], geo: str, month: str, columns: tuple[str, ...],
                 how: str, rows: int) -> DataFrame:
    """The lookups through one row per geo, which holds its calendar as an array with a place for every month.

    The ``rows`` of ``ref`` are gathered in tasks of a bounded number of rows, which are sorted in memory.

    A date finds its entry by its distance from the geo's first month, in constant time, and takes it if the dates are equal.
    """
    at, entry = month_index(F.col(month)), F.struct(F.col(month).alias("date"), F.struct(*columns).alias("value"))
    dated = ref.where(F.col(month).isNotNull()).select(geo, at.alias("key"), entry.alias("value"))
    tasks = max(int(ref.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // CALENDAR_ROWS))
    by_month = dated.repartition(tasks, geo).groupBy(geo).agg(F.sort_array(F.collect_list(F.struct("key", "value"))).alias("_e"))
    first, last = F.col("_e")[0]["key"], F.element_at("_e", -1)["key"]
    span, found = F.sequence(first, last), F.map_from_entries("_e")
    # A calendar without gaps is the sorted list itself; a month found twice stops the job in the map of the others.
    months = F.when(F.col("_e.key") == span, F.col("_e.value")).otherwise(
        F.transform(F.array(found), lambda m: F.transform(span, lambda k: F.try_element_at(m, k)))[0])
    calendar = stage(by_month.select(geo, first.alias("_first"), months.alias("_months")), "calendars")
    out = join_small(df, calendar, [geo], how, limit=0)

    def found(day):
        hit = F.get("_months", (month_index(day) - F.col("_first")).cast("int"))
        return F.when(hit["date"] == day, hit["value"])

    out = out.select(*df.columns, *[found(F.col(d).cast(ref.schema[month].dataType)).alias(f"_{p}") for p, d in dates.items()])
    if how == "inner":
        for p in dates:
            out = out.where(F.col(f"_{p}").isNotNull())
    return out.select(*df.columns, *[F.col(f"_{p}")[c].alias(f"{p}_{c}") for p in dates for c in columns])


def base_month_join(df: DataFrame, ref: DataFrame, geo: str = "zip3", base_month: dt.date = BASE_MONTH,
                    prefix: str = BASE, columns: tuple[str, ...] = ECON_COLUMNS, how: str = "inner") -> DataFrame:
    """Look ``ref`` up by geo alone, at one fixed month."""
    at_base = ref.where(F.col("month") == F.lit(base_month))
    return join_small(df, at_base.select(geo, *[F.col(c).alias(f"{prefix}_{c}") for c in columns]), [geo], how)


def join_economics(pairs: DataFrame, econ: DataFrame, geo: str = "zip3", base_month: dt.date = BASE_MONTH,
                   limit: int = BROADCAST_ROWS) -> DataFrame:
    """Economic columns at the target, as-of, first-pay and base months.

    Inner joins: a row without a match at any of the four dates disappears
    (see ``econ_losses``).  ``econ`` is the rolled-up table, staged.
    """
    out = multi_date_join(pairs, econ, DATES, geo, columns=(*ECON_COLUMNS, "msa_name_loc"), limit=limit)
    out = out.withColumnRenamed("trg_msa_name_loc", "msa_loc_name").drop(
        *[f"{p}_msa_name_loc" for p in DATES if p != "trg"])
    return base_month_join(out, econ, geo, base_month)


def econ_losses(pairs: DataFrame, econ: DataFrame, geo: str = "zip3", base_month: dt.date = BASE_MONTH) -> DataFrame:
    """Rows the inner economic joins would lose, by the date that has no match."""
    out = multi_date_join(pairs.select(geo, *DATES.values()), econ, DATES, geo, columns=("month",), how="left")
    out = base_month_join(out, econ, geo, base_month, columns=("month",), how="left")
    found = {p: F.col(f"{p}_month").isNotNull() for p in (*DATES, BASE)}
    lost_any = ~(found["trg"] & found["ao"] & found["org"] & found[BASE])
    sums = out.agg(*[F.count(F.when(~ok, 1)).alias(p) for p, ok in found.items()],
                   F.count(F.when(lost_any, 1)).alias("any"), F.count(F.lit(1)).alias("n_rows"))
    names = [*found, "any"]
    pair = F.explode(F.array(*[F.struct(F.lit(p).alias("lookup"), F.col(p).alias("lost")) for p in names])).alias("s")
    return sums.select("n_rows", pair).select("s.lookup", "s.lost", "n_rows")


def economic_features(df: DataFrame, symmetric: bool = False) -> DataFrame:
    """Columns that need loan and economic values together.

    Steps follow the dependencies: a later step uses only columns of earlier
    ones.  ``symmetric`` caps large negative labor-force growth at -25 instead
    of the default +25.
    """
    term = F.col("term")
    horizon = F.col("ao_dq") + F.col("fcst_month")
    out = df.withColumns({
        "rt15_wt": F.when(term <= 180, F.lit(1.0)).when(term >= 360, F.lit(0.0)).otherwise((360 - term) / F.lit(180.0)),
        "trg_d_hpi": F.lit(100.0) * (safe_div(F.col("trg_hpi"), F.col("org_hpi")) - 1),
        **{f"{p}_prop_val": F.col("prop_val") * safe_div(F.col(f"{p}_hpi"), F.col("org_hpi"))
           for p in ("trg", "ao", BASE)},
        "trg_dq_max": F.least(horizon, F.lit(12)),
        "trg_pti50": F.least(safe_div(F.lit(1200.0) * F.col("trg_payment"), F.col("trg_income50")), F.lit(100.0)),
    })
    w15 = F.col("rt15_wt")
    out = out.withColumns({
        "ao_eltv": safe_div(F.lit(100.0) * F.col("ao_upb"), F.col("ao_prop_val")),
        "trg_eltv": safe_div(F.lit(100.0) * F.col("trg_upb_exp"), F.col("trg_prop_val")),
        "org_spread": F.col("rate") - (w15 * F.col("org_mort_fix15") + (1 - w15) * F.col("org_mort_fix30")),
        "new_rate": w15 * F.col("trg_mort_fix15") + (1 - w15) * F.col("trg_mort_fix30"),
        "_fc_ratio": safe_div(30 * horizon, F.col("trg_fc_days")),
        "_growth": safe_div(F.lit(1200.0) * (F.col("trg_lbr_force") - F.col("org_lbr_force")),
                            F.col("org_lbr_force") * (F.col("ao_age") + F.col("fcst_month"))),
        "target_net_pro": safe_div(F.col("fcl_pro_net"), F.col("trg_prop_val")),
    })
    over = F.lit(GROWTH_CAP)
    if symmetric:
        over = F.when(F.col("_growth") < 0, F.lit(-GROWTH_CAP)).otherwise(F.lit(GROWTH_CAP))
    out = out.withColumns({
        "trg_fc_time": F.when(F.col("_fc_ratio") < MAX_RATIO, F.col("_fc_ratio")).otherwise(F.lit(MAX_RATIO)),
        "trg_lbr_growth": F.when(F.abs("_growth") < GROWTH_CAP, F.col("_growth")).otherwise(over),
        "new_r": F.col("new_rate") / F.lit(1200.0),
    })
    out = out.withColumn("new_payment", F.when(
        F.col("new_r") > 0, level_payment(F.col("new_r"), F.col("trg_upb_exp"), term)
    ).otherwise(safe_div(F.col("trg_upb_exp"), term)))
    return out.withColumn("trg_refi_incentive", F.lit(12.0) * (F.col("trg_payment") - F.col("new_payment"))).drop(
        "_fc_ratio", "_growth")


def add_economics(pairs: DataFrame, econ: DataFrame, geo: str = "zip3", base_month: dt.date = BASE_MONTH,
                  symmetric: bool = False) -> DataFrame:
    """Roll the economic table up, join it at the four dates, add the derived columns."""
    rolled = stage(rollup_econ(econ, geo), "econ")
    return economic_features(join_economics(pairs, rolled, geo, base_month), symmetric)
