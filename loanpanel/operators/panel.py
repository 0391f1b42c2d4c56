"""Pass 1: one row per (loan, as-of month) with features of its own history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanpanel.functions.expr import as_predicate, level_payment, monthly_rate, yes_no
from loanpanel.operators.sampling import SEED, narrowed, strata_rates, stratified_sample
from loanpanel.sources.profile import QA_ALL_FAIL, QA_FIELDS, SourceProfile
from loanpanel.sources.tables import BROADCAST_ROWS, checked_months, stage

LAG_MONTHS = 12
CURRENT_CAP = 36


def qa_passed() -> Column:
    """No failed check on a column the models rely on; a failed dti is tolerated."""
    failed = [F.array_contains("qa_field", f) for f in QA_FIELDS]
    failed += [F.array_contains("all_fail", f) for f in QA_ALL_FAIL]
    ok = F.lit(True)
    for f in failed:
        ok = ok & ~F.coalesce(f, F.lit(False))
    return ok


def good_loan(df: DataFrame) -> DataFrame:
    """Keep loans that passed QA; on a panel also require remaining term."""
    kept = df.where(qa_passed())
    return kept.where("ao_rem_term > 0") if "ao_rem_term" in df.columns else kept


def field_arrays(df: DataFrame) -> dict[str, Column]:
    """The history as one array per field, ``_h_<field>``.

    Fields that nothing reads are dropped from these, and with them from the
    scan: an array of structs would be read whole once it is exploded.
    """
    fields = {f"_h_{f}": F.col(f"monthly.{f}") for f in df.schema["monthly"].dataType.elementType.names}
    return fields | {"_h_month": checked_months(F.col("monthly.month"), F.col("loan_id"))}


def _loan_level_helpers(profile: SourceProfile) -> dict[str, Column]:
    """Short arrays made once per loan, read once per month.

    * ``_cur``: the first 36 months with dq = 0.  Counting the entries before a
      month gives min(36, months current before it).
    * ``_chg``: months where the known servicer changes.  The last change before
      a month is the last known servicer before it.
    """
    months, dqs = F.col("_h_month"), F.col("_h_dq")
    current = F.filter(F.zip_with(months, dqs, lambda m, d: F.when(d == 0, m)), lambda m: m.isNotNull())
    helpers = {"_cur": F.slice(current, 1, CURRENT_CAP)}
    if profile.servicer_history:
        pair = F.zip_with(months, F.col("_h_servicer"),
                          lambda m, s: F.struct(m.alias("month"), s.alias("servicer")))
        helpers["_known"] = F.filter(pair, lambda p: p["servicer"] != "unknown")
    return helpers


def as_of_rows(loans: DataFrame, profile: SourceProfile) -> DataFrame:
    """One row per month of the history of good loans; loans without history drop out.

    Loan-level QA runs before the explode.  Each row keeps its position in the
    history, so that later expressions slice a few entries instead of scanning
    the whole array; ``mon`` is the entry itself.
    """
    fields = field_arrays(loans)
    base = good_loan(loans).withColumns(fields)
    base = base.withColumns(_loan_level_helpers(profile))
    if profile.servicer_history:
        previous = F.concat(F.array(F.lit("unknown")), F.col("_known.servicer"))
        changes = F.zip_with("_known", previous, lambda p, q: F.struct(
            p["month"].alias("month"), p["servicer"].alias("servicer"), q.alias("previous")))
        base = base.withColumn("_chg", F.filter(changes, lambda p: p["servicer"] != p["previous"])).drop("_known")
    rows = base.select("*", F.posexplode("_h_month").alias("_pos", "_month"))
    entry = [F.get(F.col(name), F.col("_pos")).alias(name[3:]) for name in fields if name != "_h_month"]
    return rows.withColumn("mon", F.struct(F.col("_month").alias("month"), *entry))


def _recent_dq() -> Column:
    """dq of the months in [as-of - 12 months, as-of): at most the 12 entries before this one."""
    start = F.greatest(F.col("_pos") - F.lit(LAG_MONTHS - 1), F.lit(1))
    length = F.least(F.col("_pos"), F.lit(LAG_MONTHS))
    return F.zip_with(
        F.slice("_h_month", start, length),
        F.slice("_h_dq", start, length),
        lambda m, d: F.when(m >= F.col("lag12"), d),
    )


def as_of_values(rows: DataFrame, profile: SourceProfile) -> DataFrame:
    """Columns read straight from the loan and its as-of month."""
    out = rows.withColumns({
        "msa_loc": F.when(F.col(profile.msa) == "00000", F.col("state")).otherwise(F.col(profile.msa)),
        "ao_age": F.col("mon.age_fp_dt"),
        "has_second": yes_no(F.col("cltv") > F.col("ltv")),
        "co_borr": yes_no(F.col("num_borr") > 1),
        "no_groups": F.lit("Overall"),
        "ao_dt": F.col("mon.month"),
        "ao_dq": F.col("mon.dq"),
        "ao_dq_cap6": F.least(F.col("mon.dq"), F.lit(6)),
        "ao_upb": F.col("mon.upb"),
        "ao_mod": F.col("mon.mod"),
        "ao_bap": F.col("mon.bap"),
        "ao_zb": F.col("mon.zb"),
        "ao_rate": F.col("mon.cur_rate"),
        "ao_r": monthly_rate(F.col("mon.cur_rate"), 0.001),
        "ao_rem_term": F.col("term") - F.col("mon.age_fp_dt"),
    })
    out = good_loan(out)
    return out.withColumns({
        "age_yr": (F.col("ao_age") / F.lit(12)).cast("int"),
        "ppen36": yes_no((F.col("ao_age") <= 36) & (F.col("ppen") == "Y")),
    })


def history_features(rows: DataFrame, profile: SourceProfile) -> DataFrame:
    """Columns computed from the history before the as-of month, and the payment."""
    out = rows.withColumn("lag12", F.add_months("ao_dt", -LAG_MONTHS))
    out = out.withColumns({
        "ao_payment": level_payment(F.col("ao_r"), F.col("ao_upb"), F.col("ao_rem_term")),
        "ao_months_cur": F.size(F.filter("_cur", lambda m: m < F.col("ao_dt"))),
        "_dq12": _recent_dq(),
    })
    if profile.servicer_history:
        before = F.filter("_chg", lambda p: p["month"] < F.col("ao_dt"))
        out = out.withColumn("servicer", F.coalesce(F.try_element_at(before, F.lit(-1))["servicer"], F.lit("other")))

    def times(cond) -> Column:
        return F.size(F.filter("_dq12", cond))

    out = out.withColumns({
        "ao_max_dq12": F.greatest(F.least(F.coalesce(F.array_max("_dq12"), F.lit(0)), F.lit(6)), F.lit(0)),
        "ao_times30": times(lambda d: d == 1),
        "ao_times60": times(lambda d: d == 2),
        "ao_times90p": times(lambda d: d >= 3),
    })
    return out.withColumns({
        "ao_prior30": yes_no(F.col("ao_times30") > 0),
        "ao_prior60": yes_no(F.col("ao_times60") > 0),
        "ao_prior90p": yes_no(F.col("ao_times90p") > 0),
    })


AS_OF_COLUMNS = (
    "msa_loc", "state", "ao_age", "age_yr", "has_second", "co_borr", "ppen36", "no_groups", "ao_dt", "ao_dq",
    "ao_dq_cap6", "ao_upb", "ao_mod", "servicer", "ao_bap", "ao_zb", "ao_rate", "ao_r", "ao_rem_term", "ao_payment",
    "lag12", "ao_max_dq12", "ao_times30", "ao_times60", "ao_times90p", "ao_months_cur", "ao_prior30", "ao_prior60",
    "ao_prior90p",
)


def _select(rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    names = [c for c in AS_OF_COLUMNS if c in rows.columns and c not in keep]
    return rows.select("loan_id", *names, *keep)


def as_of_panel(loans: DataFrame, profile: SourceProfile, where: Column | str | None = None,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """All (loan, as-of month) candidates of pass 1.

    ``where`` may use the as-of columns, the loan columns and ``mon.<field>``.
    Catalyst pushes it below the history features, so rows it rejects never pay
    for them.
    """
    rows = history_features(as_of_values(as_of_rows(loans, profile), profile), profile)
    cond = as_predicate(where)
    return _select(rows if cond is None else rows.where(cond), keep)


def _only_dates(loans: DataFrame, keys: DataFrame) -> DataFrame:
    """Loans of the drawn keys, each with its drawn as-of dates (at most one per month of its history)."""
    dates = keys.groupBy("loan_id").agg(F.collect_set("ao_dt").alias("_dates"))
    return loans.join(dates, "loan_id")


def _loans_of(loans: DataFrame, keys: DataFrame) -> DataFrame:
    """``_only_dates`` for few keys, with loans without a number: the draw is then made once more, on each row's own stratum."""
    dates = stage(keys.groupBy(F.col("loan_id").alias("_drawn")).agg(F.collect_set("ao_dt").alias("_dates")), "drawn-dates")
    return loans.join(F.broadcast(dates), loans["loan_id"].eqNullSafe(dates["_drawn"])).drop("_drawn")


def sample_as_of(loans: DataFrame, profile: SourceProfile, strata: list[str], n: int,
                 where: Column | str | None = None, keep: tuple[str, ...] = (), seed: int = SEED,
                 exact: bool = False, rates: DataFrame | None = None, history_months: int | None = None) -> DataFrame:
    """Pass 1: ``as_of_panel`` sampled over ``strata``, with history features of the sampled rows only.

    The draw needs the strata and the key, so it runs on rows that carry little:

    * few strata: their rates are broadcast and the draw is a filter below the
      features; the loan table is scanned, never shuffled.  A draw of few rows is first made on keys and strata
      alone, and only its loans are unfolded with their history;
    * many strata (state x month x age x delinquency): only (key, strata) rows
      meet the rates in a shuffle, then the drawn keys go back to their loans;
    * strata or ``where`` on a history feature: the features come first.

    ``history_months`` adds what pass 2 needs of the loan: its static columns,
    and ``monthly`` from the as-of month on, to that many months later, or to its end when
    the history lacks that month: a window then ends with the history.  It is a slice of the array already
    in the row, so pass 2 does without its join.
    """
    keys = ["loan_id", "ao_dt"]
    keep = (*keep, *[c for c in strata if c not in AS_OF_COLUMNS and c not in keep])
    if history_months is not None:
        keep = (*keep, *[c for c in profile.static if c not in (*AS_OF_COLUMNS, *keep, "loan_id")], "monthly", "_offset")

    def finish(rows: DataFrame, extra: list[str] = ()) -> DataFrame:
        out = history_features(rows, profile)
        if history_months is not None:
            complete = F.array_contains("_h_month", F.add_months("ao_dt", history_months))
            entries = F.when(complete, F.lit(history_months + 1)).otherwise(F.size("_h_month"))
            out = out.withColumns({"_offset": F.col("_pos"), "monthly": F.slice("monthly", F.col("_pos") + 1, entries)})
        return _select(out, (*keep, *extra))

    rows = as_of_values(as_of_rows(loans, profile), profile)
    narrow = narrowed(rows, where, strata)
    if narrow is None:
        full = history_features(rows, profile).where(as_predicate(where) if where is not None else F.lit(True))
        thin = full.select(*dict.fromkeys([*keys, *strata]))
    else:
        thin = narrow.select(*dict.fromkeys([*keys, *strata]))
    rates = stage(strata_rates(thin, strata, n), "rates") if rates is None else rates
    if narrow is not None and rates.count() <= BROADCAST_ROWS:
        if not exact and (rates.agg(F.sum(F.col("n") * F.col("rate"))).first()[0] or 0) <= BROADCAST_ROWS / 2:
            drawn = stage(stratified_sample(thin, strata, n, keys, seed, False, rates).select(*keys), "drawn")
            if drawn.count() <= BROADCAST_ROWS:
                again = as_of_values(as_of_rows(_loans_of(loans, drawn), profile), profile)
                narrow = narrowed(again.where(F.array_contains("_dates", F.col("ao_dt"))), where, strata)
        return stratified_sample(narrow, strata, n, keys, seed, exact, rates, widen=finish)
    drawn = stage(stratified_sample(thin, strata, n, keys, seed, exact, rates).select(*keys), "drawn")
    again = as_of_values(as_of_rows(_only_dates(loans, drawn), profile), profile)
    return finish(again.where(F.array_contains("_dates", F.col("ao_dt"))))
