"""Histories out of order or with repeated months are refused or put right, never read as they are."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loanpanel.operators import sampling
from loanpanel.sources.tables import checked_months, nest_history, ordered_history

MONTHS = [dt.date(2000, m, 1) for m in range(1, 7)]


def history(spark, months):
    rows = [(1, [(float(k), m) for k, m in enumerate(months)])]
    return spark.createDataFrame(rows, "loan_id long, monthly array<struct<upb:double,month:date>>")


def months_of(df):
    return [m["month"] for m in df.collect()[0]["monthly"]]


def test_order_is_checked(spark):
    good = history(spark, MONTHS).select(checked_months(F.col("monthly.month"), F.col("loan_id")).alias("m"))
    assert good.collect()[0]["m"] == MONTHS
    for bad in (MONTHS[::-1], [*MONTHS, MONTHS[-1]], [MONTHS[1], MONTHS[0]]):
        with pytest.raises(Exception, match="ordered_history first: loan 1"):
            history(spark, bad).select(checked_months(F.col("monthly.month"), F.col("loan_id"))).collect()


def test_histories_are_put_in_order(spark):
    mixed = [MONTHS[k] for k in (3, 0, 5, 1, 4, 2)]
    out = ordered_history(history(spark, mixed))
    assert months_of(out) == MONTHS and out.dtypes == history(spark, mixed).dtypes
    assert months_of(ordered_history(history(spark, []))) == []


def test_repeats_need_a_rule(spark):
    twice = history(spark, [*MONTHS, MONTHS[2]])
    with pytest.raises(Exception, match="repeated in the history of loan 1"):
        ordered_history(twice).collect()
    kept = ordered_history(twice, "largest").collect()[0]["monthly"]
    assert [m["month"] for m in kept] == MONTHS and kept[2]["upb"] == 6.0
    tape = twice.select("loan_id", F.inline("monthly"))
    with pytest.raises(Exception, match="repeated in the history of loan 1"):
        nest_history(tape).collect()
    assert nest_history(tape, on_repeat="largest").collect()[0]["monthly"][2]["upb"] == 6.0
    with pytest.raises(ValueError):
        nest_history(tape, on_repeat="any")


def test_level_samples_do_not_follow_the_strata_draw(spark):
    rows = spark.range(60_000).select(F.col("id"), F.lit("all").alias("level"), (F.col("id") % 30 == 0).cast("int").alias("rare"))
    balanced = sampling.stratified_sample(rows, ["rare"], 4_000, ["id"])
    share = balanced.agg(F.avg("rare")).first()[0]
    picked = sampling.sample_per_level(balanced, ["level"], 1_000, ["id"])
    n, rare = picked.agg(F.count(F.lit(1)), F.avg("rare")).first()
    assert n == 1_000 and abs(rare - share) < 0.06
