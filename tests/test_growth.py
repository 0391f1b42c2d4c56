"""Work and memory that grow no faster than the tables: histories are neither broadcast nor shuffled per as-of row."""

import datetime as dt

from pyspark.sql import functions as F

import pytest

from loanpanel.operators import econ as economics
from loanpanel.operators import panel, sampling, targets
from loanpanel.plans import queries as q
from loanpanel.sources import fixtures as fx
from loanpanel.sources.tables import nest_history, stage


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_loan_join_never_broadcasts_histories(spark, sf):
    base = q.loans(spark, sf)
    sample = panel.as_of_panel(base, fx.SOURCE, q.WHERE1)
    assert "BroadcastHashJoin" not in plan(targets.target_window(sample, base, fx.SOURCE, q.WINDOW))
    assert "BroadcastHashJoin" not in plan(targets.target_pairs(sample, base, fx.SOURCE))


def test_carried_histories_need_no_shuffle_and_give_the_rows_of_the_join(spark, sf):
    for profile in (fx.SOURCE, fx.SECOND):
        base = q.loans(spark, sf).where("loan_id % 10 = 0")
        sample = panel.as_of_panel(base, profile, q.WHERE1)
        carried = targets.with_history(base, profile, q.WHERE1)
        assert "Exchange" not in plan(carried)
        window = targets.window_rows(carried, q.WINDOW)
        assert rows(targets.target_window(sample, base, profile, q.WINDOW).select(*window.columns)) == rows(window)
        pairs = targets.explode_targets(carried, profile)
        assert rows(targets.target_pairs(sample, base, profile).select(*pairs.columns)) == rows(pairs)


def test_repeated_and_missing_loan_numbers_meet_the_same_histories(spark, sf):
    base = q.loans(spark, sf).where("loan_id % 10 = 0")
    again = base.where("loan_id % 20 = 0").withColumns({"fico": F.lit(1), "monthly": F.slice("monthly", 3, 100)})
    base = stage(base.unionByName(again).unionByName(again).unionByName(
        base.where("loan_id = 30").withColumn("loan_id", F.lit(None).cast("bigint"))), "again")
    sample = panel.as_of_panel(base, fx.SOURCE, q.WHERE1)
    carried = targets.with_history(base, fx.SOURCE, q.WHERE1)
    for rows_of, joined in ((lambda d: targets.window_rows(d, q.WINDOW), targets.target_window(sample, base, fx.SOURCE, q.WINDOW)),
                            (lambda d: targets.explode_targets(d, fx.SOURCE), targets.target_pairs(sample, base, fx.SOURCE))):
        got = rows_of(carried)
        assert rows(joined.select(*got.columns)) == rows(got)


def test_queries_of_pairs_and_windows_join_no_loans(spark, sf):
    for profile in (fx.SOURCE, fx.SECOND):
        assert "Join" not in plan(q.pairs(spark, sf, profile=profile)) + plan(q.windowed(spark, sf, profile))
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_every_window_is_a_row(spark, sf):
    got = q.all_queries()["target_window"](spark, sf)
    assert {"loan_id", "ao_dt", "l_index", "target_pp"} <= set(got.columns)
    assert got.count() == q.windowed(spark, sf).count() == got.select("loan_id", "ao_dt").distinct().count()


def test_tapes_are_unfolded_in_tasks_of_bounded_size(spark, sf, monkeypatch):
    monkeypatch.setattr(fx, "MONTHS_PER_TASK", 50)
    monkeypatch.setattr(fx, "ZIPS_PER_TASK", 10)
    loans, econ = fx.nested_loans(spark, sf), fx.econ_table(spark, sf)
    assert stage(loans, "many").inputFiles().__len__() > 8
    assert "Exchange" not in plan(econ).split("explode")[0]  # dealt below the explode, not above it
    assert econ.rdd.getNumPartitions() == -(-econ.select("zip").distinct().count() // 10)


def test_nesting_takes_as_many_tasks_as_the_tape_has_files(spark):
    tape = spark.range(0, 4000, 1, 40).select(
        (F.col("id") % 500).alias("loan_id"), F.add_months(F.lit(dt.date(2000, 1, 1)), (F.col("id") / 500).cast("int")).alias("month"),
        F.col("id").alias("upb"))
    nested = nest_history(stage(tape, "tape"))
    assert nested.count() == 500 and nested.rdd.getNumPartitions() == 40


def test_the_rollup_sorts_no_row_of_the_finer_table(spark, sf):
    rolled = economics.rollup_econ(fx.staged(spark, sf, "econ"))
    first_step = [line for line in plan(rolled).splitlines() if "Aggregate" in line][-1]
    assert "HashAggregate" in first_step and "Sort" not in first_step


def test_the_rollup_is_over_all_rows_whatever_their_texts(spark):
    names = "zip3 string, zip3_hpi double, unemp_rate double, lbr_force double, msa_name string, state string, fc_days int, fc_type string"
    table = spark.createDataFrame([
        ("001", 1.0, 2.0, 10.0, "B", "S1", 5, None), ("001", 2.0, 4.0, 30.0, "A", "S2", 7, "x"), ("001", None, None, 60.0, "A", "S2", 6, "y"),
        ("002", None, 1.0, None, None, None, None, None), ("002", None, 1.0, None, "", "S3", 1, None)], names)
    rates = {c: F.lit(3.0) for c in ("mort_fix30", "mort_fix15", "treas10", "q10", "q25", "q50", "q75", "q90")}
    got = economics.rollup_econ(table.withColumns({"month": F.lit(dt.date(2000, 1, 1)), **rates})).select(
        "zip3", "hpi", "unemp_rate", "lbr_force", "msa_name_loc", "fc_days", "fc_type")
    assert rows(got) == [("001", 1.5, 1.4, 100.0, "B", 7, "y"), ("002", None, None, None, "S3", 1, None)]


def test_calendars_are_gathered_in_tasks_of_bounded_size(spark, monkeypatch):
    """With and without gaps; a month that a geo has twice stops the job."""
    seen = []
    monkeypatch.setattr(economics, "CALENDAR_ROWS", 20)
    monkeypatch.setattr(economics, "stage", lambda df, label: seen.append(df.rdd.getNumPartitions()) or stage(df, label))
    month = F.add_months(F.lit(dt.date(2000, 1, 1)), (F.col("id") % 12).cast("int"))
    ref = stage(spark.range(480).select(F.floor(F.col("id") / 12).alias("geo"), month.alias("month"), F.col("id").alias("v")).where(
        "geo % 2 = 0 OR v % 3 > 0"), "ref")
    df = stage(spark.range(480).select(F.floor(F.col("id") / 12).alias("geo"), month.alias("day")), "days")
    got = economics.multi_date_join(df, ref, {"at": "day"}, "geo", how="left", limit=0)
    wanted = df.join(ref.withColumnRenamed("month", "day"), ["geo", "day"], "left").select("geo", "day", F.col("v").alias("at_v"))
    assert rows(got) == rows(wanted) and seen == [-(-ref.count() // 20)]
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        economics.multi_date_join(df, stage(ref.unionByName(ref.where("v = 5")), "twice"), {"at": "day"}, "geo", limit=0).collect()


def test_a_small_draw_unfolds_the_drawn_loans_only(spark, sf):
    base = q.loans(spark, sf)
    again = base.where("loan_id % 3 = 0").withColumns({"state": F.lit("again"), "monthly": F.slice("monthly", 2, 100)})
    none = base.where("loan_id % 7 = 0").withColumn("loan_id", F.lit(None).cast("bigint"))
    base = stage(base.unionByName(again).unionByName(none), "odd-loans")
    strata = ["state", "ao_dq_cap6"]
    whole = panel.as_of_panel(base, fx.SOURCE, q.WHERE1)
    got = panel.sample_as_of(base, fx.SOURCE, strata, 300, q.WHERE1)
    assert "_dates" in plan(got)
    assert rows(got) == rows(sampling.stratified_sample(whole, strata, 300, q.KEYS1).select(*got.columns))


def test_the_widened_book_is_written_once(spark, sf, monkeypatch):
    seen = []
    monkeypatch.setattr(q, "stage", lambda df, label: seen.append(label) or stage(df, label))
    monkeypatch.setattr(q, "run", lambda *_: (_ for _ in ()).throw(KeyError))
    with pytest.raises(KeyError):
        q.all_columns(spark, sf, q.PAY_PLAN)
    assert seen == ["wide"]
