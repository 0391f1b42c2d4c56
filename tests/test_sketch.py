"""The one-pass draw against the two-pass one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanpanel.operators import sampling, sketch


def rows_of(spark):
    rows = spark.range(40_000).selectExpr("id AS loan_id", "date_add(DATE'2020-01-01', CAST(id % 7 AS INT)) AS ao_dt",
                                          "IF(id % 10 < 6, 'hot', IF(id % 101 = 0, NULL, concat('s', id % 13))) AS state",
                                          "CAST(id % 3 AS INT) AS dq")
    return rows.withColumn("dq", F.when(F.col("loan_id") % 5 != 0, F.col("dq")))


@pytest.mark.parametrize("target,least", [(3_000, 64), (3_000, 4096), (100_000, 64), (50, 8), (0, 8)])
@pytest.mark.parametrize("spread", ["even", "by stratum"])
def test_same_rows_and_rates_as_two_passes(spark, target, least, spread):
    rows, cols, keys = rows_of(spark), ["state", "dq"], ["loan_id", "ao_dt"]
    rows = rows.repartition(6, "loan_id") if spread == "even" else rows.repartition(6, "state")
    rates = sampling.strata_rates(rows, cols, target)
    want = sampling.stratified_sample(rows, cols, target, keys, rates=rates).select(*keys, *cols)
    drawn, found = sketch.draw_in_one_pass(rows, cols, target, keys, least=least, tasks=6)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, drawn.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(map(tuple, rates.collect()), key=key)


def test_a_task_keeps_a_bounded_number_of_rows(spark):
    kept = sketch.sketched(rows_of(spark).repartition(4, "loan_id"), ["state"], 1_000, ["loan_id"], least=100, tasks=4)
    rows, counts = kept.where("_n IS NULL").count(), kept.agg(F.sum("_n")).first()[0]
    assert counts == 40_000 and rows < 4 * 500 + 4 * 15 * 2


def test_tasks_are_reckoned_from_files(spark, tmp_path):
    assert sketch.least_tasks(spark.range(5)) == 1
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "t"))
    assert sketch.least_tasks(spark.read.parquet(str(tmp_path / "t")).where("id > 3")) == min(3, spark.sparkContext.defaultParallelism)


def test_no_rows(spark):
    drawn, rates = sketch.draw_in_one_pass(rows_of(spark).limit(0), ["state"], 10, ["loan_id"])
    assert drawn.count() == 0 and rates.count() == 0


def test_cap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        sizes = rng.integers(1, 50, rng.integers(1, 9))
        wanted = float(rng.uniform(0.5, sizes.sum() - 0.5)) if sizes.sum() > 1 else 0.5
        assert np.minimum(sizes, sketch._cap(sizes, wanted)).sum() == pytest.approx(wanted)
    assert sketch._cap(np.array([3, 4]), 7) == float("inf")
