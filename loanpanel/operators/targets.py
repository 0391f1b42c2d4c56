"""Pass 2: target dates for sampled as-of rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanpanel.functions.expr import (
    NO_BOUND,
    as_predicate,
    balance_after,
    digest_bound,
    flag,
    key_digest,
    level_payment,
    month_index,
    monthly_rate,
    months_apart,
    yes_no,
)
from loanpanel.operators.digests import low_pairs
from loanpanel.operators.panel import AS_OF_COLUMNS, as_of_panel, good_loan
from loanpanel.operators.sampling import SEED, drawn_below, narrowed, strata_rates, stratified_sample
from loanpanel.sources.profile import SourceProfile
from loanpanel.sources.tables import BROADCAST_ROWS, checked_months, stage

MAX_FORECAST = 180
COVID = (dt.date(2020, 4, 1), dt.date(2022, 4, 1))
FIRST_PERIOD = 2019
WINDOW_FIELDS = ("month", "zb", "dq", "mod", "cur_rate")  # of the history, that a window looks at


def carried_columns(profile: SourceProfile) -> list[str]:
    """What pass 2 keeps of an as-of row and its loan, besides the history."""
    static = [c for c in profile.static if c != "loan_id"]
    return ["loan_id", "ao_r", *[c for c in profile.carried if c not in static], *static]


def join_history(sample: DataFrame, loans: DataFrame, profile: SourceProfile) -> DataFrame:
    """Sampled as-of rows with their loan's static columns and history.

    A loan has one row on one side and at most one row per month on the other;
    skew left over is split by AQE at run time.  Samples drawn with
    ``history_months`` carry all this already and need no join.
    """
    static = [c for c in profile.static if c != "loan_id"]
    left = sample.select(*[c for c in carried_columns(profile) if c not in static])
    # Histories unfold to many times the size of their files: never broadcast on that size.
    return left.join(loans.select("loan_id", *static, "monthly").hint("shuffle_hash"), "loan_id")


def with_history(loans: DataFrame, profile: SourceProfile, where: Column | str | None = None) -> DataFrame:
    """All as-of rows with their loan's static columns and history: ``as_of_panel`` and ``join_history`` in one scan.

    The explode of the loans has the history at hand, as an array per field, so no row is shuffled.  ``_start`` is the place of the
    as-of month in it, 0 if it is not there.  Loans whose number repeats, which are counted first, go through the join: each of
    their as-of rows meets each of their histories.  Loans without a number meet none.
    """
    loans = loans.where(F.col("loan_id").isNotNull())
    fields = [f"_h_{f}" for f in dict.fromkeys([*profile.monthly.values(), *WINDOW_FIELDS])]
    texts = F.col("monthly.month").cast("array<string>").alias("_h_text")  # once a loan, for the digests of its pairs
    own = [c for c in profile.static if c != "loan_id" and c not in AS_OF_COLUMNS]

    def at_hand(part: DataFrame) -> DataFrame:
        rows = as_of_panel(part.select("*", texts), profile, where, (*own, "_pos", "_h_text", *fields))
        return rows.select(*carried_columns(profile), (F.col("_pos") + 1).alias("_start"), "_h_text", *fields)

    repeated, n = repeated_numbers(loans)
    if not n:
        return at_hand(loans)
    listed = F.broadcast(repeated) if n <= BROADCAST_ROWS else repeated
    several = loans.join(listed, "loan_id", "left_semi")
    joined = join_history(as_of_panel(several, profile, where), several, profile).select("*", texts).withColumns(history_arrays(fields))
    start = F.array_position("_h_month", F.col("ao_dt")).cast("int").alias("_start")
    return at_hand(loans.join(listed, "loan_id", "left_anti")).unionByName(joined.select(*carried_columns(profile), start, "_h_text", *fields))


def repeated_numbers(loans: DataFrame) -> tuple[DataFrame, int]:
    """Staged loan numbers that are found more than once, and how many they are."""
    numbers = loans.groupBy("loan_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = stage(numbers.where("n > 1").select("loan_id"), "repeated")
    return repeated, repeated.count()


def book_months(loans: DataFrame) -> DataFrame:
    """``loan_id, months``: the months that the as-of and target dates of ``with_history`` are found in.

    The histories of a number that repeats meet each other, so they make one list.
    """
    loans = loans.where(F.col("loan_id").isNotNull())
    months = F.sort_array(F.array_compact("monthly.month")).alias("months")
    repeated, n = repeated_numbers(loans)
    if not n:
        return good_loan(loans).select("loan_id", months)
    listed = F.broadcast(repeated) if n <= BROADCAST_ROWS else repeated
    several = loans.join(listed, "loan_id", "left_semi").select("loan_id", F.explode("monthly.month").alias("_month"))
    lists = several.groupBy("loan_id").agg(F.sort_array(F.collect_set("_month")).alias("months"))
    return good_loan(loans.join(listed, "loan_id", "left_anti")).select("loan_id", months).unionByName(lists)


def calendar_columns(covid=COVID, first_period: int = FIRST_PERIOD) -> dict[str, Column]:
    trg = F.col("trg_dt")
    first, last = (F.lit(d.year * 12 + d.month) for d in covid)
    return {
        "trg_yr_qtr": F.concat(F.year(trg).cast("string"), F.lit("Q"), F.quarter(trg).cast("string")),
        "periods": F.when(F.year(trg) >= first_period, F.year(trg).cast("string"))
        .otherwise(F.lit(f"Before {first_period}")),
        "covid": yes_no(month_index(trg).between(first, last)),
    }


def expected_columns(months: Column, rate: Column, rate_used: Column) -> dict[str, Column]:
    """Scheduled balance after ``months`` and the level payment from there on."""
    return {
        "trg_r": monthly_rate(rate, 0.01),
        "trg_upb_exp": balance_after(F.col("ao_upb"), F.col("ao_payment"), F.col("ao_r"), months),
    } | {"_pay_r": F.when(rate > 0, rate_used).otherwise(F.col("ao_r"))}


def _payment() -> Column:
    return level_payment(F.col("_pay_r"), F.col("trg_upb_exp"), F.col("trg_rem_term"))


def history_arrays(names) -> dict[str, Column]:
    """The fields of ``monthly`` as one array each."""
    return {a: F.col(f"monthly.{a[3:]}") for a in names} | {"_h_month": checked_months(F.col("monthly.month"), F.col("loan_id"))}


def target_rows(joined: DataFrame, profile: SourceProfile, max_months: int = MAX_FORECAST, texts: bool = False) -> DataFrame:
    """One row per (as-of row, target month) with the outcome of that month.

    The history is sorted with one row per month, so the reachable months are
    the as-of row and the ``max_months`` entries after it: it is cut to those
    before the explode.  One array per field lets the scan skip unread fields.

    ``texts`` adds what ``pair_digest`` reads, made of months and as-of rows, not of pairs: a pair would spend as long on
    writing its dates as on their digest.
    """
    arrays = [f"_h_{f}" for f in ("month", *sorted(set(profile.monthly.values()) - {"month"}))]
    flat = joined
    if "_start" not in joined.columns:
        flat = flat.withColumns(history_arrays(arrays)).drop("monthly", "_offset")
        flat = flat.withColumn("_start", F.array_position("_h_month", F.col("ao_dt")).cast("int"))
    flat = flat.withColumn("_start", F.greatest("_start", F.lit(1)))
    if texts:
        flat = flat.withColumn("_as_of", F.concat_ws("|", F.col("loan_id").cast("string"), F.col("ao_dt").cast("string")))
        arrays = [*arrays, "_h_text"] if "_h_text" in flat.columns else arrays
    trimmed = flat.withColumns({a: F.slice(a, F.col("_start"), max_months + 1) for a in arrays})
    if texts and "_h_text" not in trimmed.columns:
        trimmed = trimmed.withColumn("_h_text", F.col("_h_month").cast("array<string>"))
    if "_dates" in joined.columns:  # only the wanted months become rows
        wanted = F.filter(F.transform("_h_month", lambda m, i: F.struct(i.alias("pos"), m.alias("month"))),
                          lambda at: F.array_contains("_dates", at["month"]))
        rows = trimmed.withColumn("_at", F.explode(wanted)).withColumns({"_pos": F.col("_at.pos"), "_month": F.col("_at.month")})
        rows = rows.drop("_at", "_dates")
    else:
        rows = trimmed.select("*", F.posexplode("_h_month").alias("_pos", "_month"))
    rows = rows.withColumns({
        name: F.col("_month") if f == "month" else F.get(F.col(f"_h_{f}"), F.col("_pos"))
        for name, f in profile.monthly.items()
    } | ({"_trg_text": F.get(F.col("_h_text"), F.col("_pos"))} if texts else {})).drop("_pos", "_month", "_start", *[c for c in rows.columns if c.startswith("_h_")])
    rows = rows.withColumns({
        "fcst_month": months_apart("ao_dt", "trg_dt"),
        "trg_rem_term": F.col("term") - F.col("trg_age"),
    })
    rows = rows.where(F.col("fcst_month").between(0, max_months) & (F.col("trg_rem_term") > 0))
    rows = rows.withColumns({
        "short_sale": yes_no(F.col("trg_zb") == "03"),
        "target_mod": flag(F.col("trg_mod") == "Y"),
        "target_assist": flag(profile.assisted()),
        "target_dq": F.least(F.greatest(F.col("trg_dq"), F.lit(0)), F.lit(12)),
        "target_death": F.when(F.col("trg_zb") == "00", 0).when(F.col("trg_zb") == "01", 1).otherwise(2),
    })
    return rows.withColumn("target_status", F.when(F.col("trg_zb") == "00", F.col("target_dq"))
                           .when(F.col("trg_zb") == "01", 13).otherwise(14))


def pair_digest(seed: int = SEED) -> Column:
    """``key_digest`` of loan, as-of and target month for ``target_rows`` with texts, whose as-of month is known."""
    return F.md5(F.concat_ws("|", "_as_of", "_trg_text", F.lit(str(seed))))


def target_features(rows: DataFrame, covid=COVID, first_period: int = FIRST_PERIOD) -> DataFrame:
    """Scheduled balance, payment and calendar columns of target rows."""
    rate = F.col("trg_rate")
    rows = rows.withColumns(expected_columns(F.col("fcst_month"), rate, rate / F.lit(1200.0)))
    return rows.withColumns({"trg_payment": _payment(), **calendar_columns(covid, first_period)}).drop("_pay_r")


def explode_targets(joined: DataFrame, profile: SourceProfile, where: Column | str | None = None,
                    max_months: int = MAX_FORECAST, covid=COVID, first_period: int = FIRST_PERIOD) -> DataFrame:
    """All target rows with all their columns."""
    rows = target_features(target_rows(joined, profile, max_months), covid, first_period)
    cond = as_predicate(where)
    return rows if cond is None else rows.where(cond)


def draw_targets(joined: DataFrame, profile: SourceProfile, strata: list[str], n: int,
                 where: Column | str | None = None, max_months: int = MAX_FORECAST, covid=COVID,
                 first_period: int = FIRST_PERIOD, seed: int = SEED, exact: bool = False,
                 book: DataFrame | None = None, unfold: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Pass 2: ``(target rows sampled over strata, strata table)``; only the sampled rows get all their columns.

    The pairs outnumber ``joined`` some thirty times and are never stored: one explode of their strata gives the counts,
    another of their keys and strata the draw.  The drawn target dates then go back to their as-of rows, at most
    ``max_months + 1`` to each, and only they become rows.

    ``joined`` may be all as-of rows of a book, ``unfold(book)`` with ``with_history``.  The second explode is then of the loans alone
    that have a pair below the highest bound of all strata, if there are so few pairs: ``low_pairs`` finds them from the months.
    """
    keys = ["loan_id", "ao_dt", "trg_dt"]

    def thin(rows: DataFrame, texts: bool = False) -> DataFrame:
        rows = target_rows(rows, profile, max_months, texts)
        pairs = narrowed(rows, where, strata)
        if pairs is None:
            cond = as_predicate(where)
            pairs = target_features(rows, covid, first_period)
            pairs = pairs if cond is None else pairs.where(cond)
        return pairs.select(*dict.fromkeys([*keys, *strata]), *(["_as_of", "_trg_text"] if texts else []))

    def only(rows: DataFrame, of: DataFrame) -> DataFrame:
        dates = of.groupBy("loan_id", "ao_dt").agg(F.collect_set("trg_dt").alias("_dates"))
        return rows.join(F.broadcast(dates) if of.count() <= BROADCAST_ROWS else dates, ["loan_id", "ao_dt"])

    rates = stage(strata_rates(thin(joined), strata, n), "pass2-rates")
    months = None if exact or book is None else book_months(book)
    bound = None if months is None else _low_bound(rates, months)
    if bound is not None:
        low = stage(low_pairs(months, bound, max_months, seed), "low-pairs")
        joined = unfold(stage(book.join(F.broadcast(low.select("loan_id").distinct()), "loan_id", "left_semi"), "low-loans"))
    if exact:
        picked = stratified_sample(thin(joined), strata, n, keys, seed, True, rates)
    elif bound is not None:
        picked = drawn_below(thin(only(joined, low)), strata, rates, key_digest(*keys, seed=seed))
    else:
        picked = drawn_below(thin(joined, True), strata, rates, pair_digest(seed))
    drawn = stage(picked.select(*keys), "drawn")
    return target_features(target_rows(only(joined, drawn), profile, max_months), covid, first_period), rates


def _low_bound(rates: DataFrame, months: DataFrame) -> str | None:
    """The highest bound of all strata; None where more pairs of months than can be broadcast are expected below it."""
    rate = rates.agg(F.max("rate")).first()[0]
    if rate is None or (bound := rates.select(digest_bound(F.lit(rate))).first()[0]) >= NO_BOUND:
        return None
    size = F.size("months").cast("double")
    pairs = months.agg(F.sum(size * (size + 1) / 2)).first()[0] or 0.0
    return bound if rate * pairs <= BROADCAST_ROWS else None


def sample_targets(joined: DataFrame, profile: SourceProfile, strata: list[str], n: int, where: Column | str | None = None,
                   **options) -> DataFrame:
    """The rows of ``draw_targets``."""
    return draw_targets(joined, profile, strata, n, where, **options)[0]


def target_pairs(sample: DataFrame, loans: DataFrame, profile: SourceProfile, where: Column | str | None = None,
                 max_months: int = MAX_FORECAST, covid=COVID, first_period: int = FIRST_PERIOD) -> DataFrame:
    """All (as-of date, target date) rows of the sampled as-of dates."""
    return explode_targets(join_history(sample, loans, profile), profile, where, max_months, covid, first_period)


def last_month(loans: DataFrame):
    """Last month found in any history (one value)."""
    return loans.agg(F.max(F.array_max("monthly.month"))).first()[0]


def target_window(sample: DataFrame, loans: DataFrame, profile: SourceProfile, months: int,
                  where: Column | str | None = None, censor_guard: bool = False, covid=COVID,
                  first_period: int = FIRST_PERIOD) -> DataFrame:
    """Performance over the ``months`` that follow each sampled as-of date.

    ``censor_guard`` drops as-of dates whose window runs past the last month of
    the loan table.
    """
    if censor_guard:
        sample = uncensored(sample, loans, months)
    return window_rows(join_history(sample, loans, profile), months, where, covid, first_period)


def uncensored(sample: DataFrame, loans: DataFrame, months: int) -> DataFrame:
    return sample.where(F.col("ao_dt") <= F.add_months(F.lit(last_month(loans)), -months))


def window_rows(joined: DataFrame, months: int, where: Column | str | None = None, covid=COVID,
                first_period: int = FIRST_PERIOD) -> DataFrame:
    """Window columns of as-of rows joined with their history.

    Nothing is exploded: events are looked up in the slice of the history from
    the as-of row to the window end, or to the end of the history when the loan
    left earlier.  A history cut at the as-of month tells how much was cut in
    ``_offset``.
    """
    if not 1 <= months <= 60:
        raise ValueError("window must be 1..60 months")
    carried = "_start" in joined.columns
    offset = F.col("_offset") if "_offset" in joined.columns else F.lit(0)
    rows = joined.withColumns({
        "window": F.lit(months),
        "trg_dt": F.add_months("ao_dt", months),
        "trg_age": F.col("ao_age") + F.lit(months),
        "trg_rem_term": F.col("term") - F.col("ao_age") - F.lit(months),
        **({} if carried else history_arrays(f"_h_{f}" for f in WINDOW_FIELDS)),
    }).drop("monthly")
    rows = rows.withColumn("fcst_month", months_apart("ao_dt", "trg_dt"))
    rows = rows.where(F.col("fcst_month").between(0, MAX_FORECAST) & (F.col("trg_rem_term") > 0))

    # Written as one projection: repeated parts are evaluated once, and arrays pass one step only.
    def entries(field: str) -> Column:
        return F.col(f"_h_{field}")

    first = F.col("_start") if carried else F.array_position(entries("month"), F.col("ao_dt")).cast("int")
    end = F.array_position(entries("month"), F.col("trg_dt")).cast("int")
    last = F.when(end == 0, F.size(entries("month"))).otherwise(end)
    start = F.greatest(first, F.lit(1))
    length = F.greatest(last - start + 1, F.lit(0))

    def seen(field: str) -> Column:
        return F.slice(entries(field), start, length)

    rate, end_rate = F.col("ao_rate"), F.try_element_at(entries("cur_rate"), last)
    rows = rows.withColumns({
        "f_index": first + offset,
        "l_index": last + offset,
        "end_age": F.col("ao_age") + last - first,
        "trg_zb": F.try_element_at(entries("zb"), last),
        "trg_rate": F.when(end_rate == 0, rate).otherwise(end_rate),
        "target_pp": flag(F.array_contains(seen("zb"), "01")),
        "target_default": flag(F.array_contains(seen("zb"), "03") | F.array_contains(seen("zb"), "09")),
        "target_dq120": flag(F.array_max(seen("dq")) >= 4),
        "target_mod": flag(F.array_contains(seen("mod"), "Y")),
        **expected_columns(F.lit(months), rate, rate / F.lit(1200.0)),
        **calendar_columns(covid, first_period),
    }).drop("_offset", "_start", *[c for c in rows.columns if c.startswith("_h_")])
    rows = rows.withColumn("trg_payment", _payment()).drop("_pay_r")
    cond = as_predicate(where)
    return rows if cond is None else rows.where(cond)
