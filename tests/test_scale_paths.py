"""The paths taken by large or skewed data give the same rows as the small ones."""

import pytest
from pyspark.sql import functions as F

from loanpanel.functions.expr import hash28
from loanpanel.operators import assess, running, sampling
from loanpanel.operators.network import coalesce_target
from loanpanel.sources import fixtures as fx
from loanpanel.sources import tables
from loanpanel.sources.tables import join_small, stage


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def scored(spark, sf):
    return coalesce_target(fx.staged(spark, sf, "scored"), [0])


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows in one group and one value."""
    return stage(spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(hash28("id") / F.lit(2.0 ** 28)).alias("fit"),
        (F.col("id") % 2).cast("double").alias("obs")), "hot")


@pytest.mark.parametrize("by", [None, "g"])
def test_ranges_do_not_change_tables(hot, by):
    for f in (lambda n: assess.ks(hot, by, n), lambda n: assess.decile(hot, ["id"], by, n),
              lambda n: assess.axis_range(hot, by, n)):
        assert_close(rows(f(50)), rows(f(10 ** 6)))


def assert_close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            assert u == (pytest.approx(v, abs=1e-9) if isinstance(v, float) else v)


def test_quantiles_by_brute_force(hot):
    got = {r["g"]: r["q"] for r in running.group_quantiles(hot, ["g"], "fit", [0.1, 0.5, 1.0], 40).collect()}
    pdf = hot.toPandas()
    for g, part in pdf.groupby("g"):
        v = sorted(part["fit"])
        for p, q in zip((0.1, 0.5, 1.0), got[g]):
            assert q == next(x for i, x in enumerate(v) if (i + 1) >= p * len(v) - 1e-9)


def test_deciles_are_equal_and_complete(hot):
    got = assess.decile(hot, ["id"], "g", 50).toPandas()
    sizes = hot.groupBy("g").count().toPandas().set_index("g")["count"]
    for g, part in got.groupby("slice"):
        assert part["n"].sum() == sizes[g] and part["n"].max() - part["n"].min() <= 1


def test_ranks_within_ties(hot):
    small = running.rank_in_ties(hot, ["g"], ["id"], 10)
    for g, part in small.toPandas().groupby("g"):
        assert sorted(part["tie_rank"]) == list(range(len(part)))


def test_salted_join_matches_broadcast(hot):
    keyed = hot.withColumn("g", F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("g")))
    small = stage(keyed.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "small")
    a, b = join_small(keyed, small, ["g"]), join_small(keyed, small, ["g"], limit=0)
    assert rows(a) == rows(b) and a.count() == 6000
    assert rows(a) == rows(join_small(keyed, small, ["g"], limit=0, hot_rows=100))
    assert rows(a) == rows(join_small(keyed, small, ["g"], limit=0, hot_rows=100, sizes=small))
    c = join_small(keyed, small.where("g = 'hot'"), ["g"], "left", limit=0, hot_rows=100)
    assert c.count() == 6000


def test_salt_spreads_a_hot_key(spark, hot):
    small = stage(hot.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "small")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = join_small(hot, small, ["g"], limit=0, hot_rows=100).where("g = 'hot'").groupBy(F.spark_partition_id()).count()
        assert parts.count() >= 6 and parts.agg(F.max("count")).first()[0] < 800
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_exact_sample_refines_and_stays_exact(hot):
    takes = hot.groupBy("g").agg(F.floor(F.count(F.lit(1)) / 3).alias("_take"))
    a = sampling.take_lowest_hash(hot, ["g"], takes, ["id"])
    b = sampling.take_lowest_hash(hot, ["g"], takes, ["id"], group_rows=0)
    assert rows(a) == rows(b)
    want = {r["g"]: r["_take"] for r in takes.collect()}
    assert {r["g"]: r["count"] for r in a.groupBy("g").count().collect()} == want


def test_caps_fill_the_target(spark):
    counts = stage(spark.createDataFrame([("a", 1000), ("b", 10), ("c", 100), ("d", 100)], "g string, n bigint"), "counts")
    for target in (1, 39, 40, 250, 1209):
        cap = sampling.balanced_cap(counts, target)
        assert sum(min(n, cap) for n in (1000, 10, 100, 100)) == pytest.approx(target)
    assert sampling.balanced_cap(counts, 5000) is None


def test_rates_stay_in_range_and_add_up(hot):
    r = sampling.strata_rates(hot, ["g"], 1200).toPandas()
    assert r["rate"].between(0, 1).all() and r["expected"].sum() == pytest.approx(1200)


def test_samples_repeat(hot):
    a = sampling.stratified_sample(hot, ["g"], 900, ["id"])
    assert rows(a) == rows(sampling.stratified_sample(hot.repartition(3), ["g"], 900, ["id"]))
    assert rows(a) != rows(sampling.stratified_sample(hot, ["g"], 900, ["id"], seed=11))
    assert 750 < a.count() < 1050


def test_a_third_of_all_orders_by_one_customer(spark, sf):
    """One customer with a third of the orders still nests to one row per month."""
    orders = fx.table(spark, sf, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")))
    months = fx.order_months(orders).groupBy("loan_id").count()
    assert months.agg(F.max("count")).first()[0] <= 84


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_single_partition_step(spark, sf):
    from loanpanel.plans import queries as q
    for df in (q.as_of(spark, sf), q.pairs(spark, sf), q.windowed(spark, sf), q.with_economics(spark, sf),
               sampling.stratified_sample(q.as_of(spark, sf), ["state"], 100, q.KEYS1),
               assess.score_cells(q.binary(spark, sf), "slicer"), assess.curves(q.binary(spark, sf), "month")):
        assert "SinglePartition" not in plan(df)


def test_economic_lookups_are_broadcast_and_panel_has_no_shuffle(spark, sf):
    from loanpanel.plans import queries as q
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rolled = q.rolled_econ(spark, sf)
        from loanpanel.operators import econ
        base = stage(q.windowed(spark, sf), "base")
        assert plan(econ.join_economics(base, rolled, "zip3", q.BASE_MONTH)).count("BroadcastHashJoin") == 4
        assert "Exchange" not in plan(q.as_of(spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_loan_quality_filter_runs_below_the_explode(spark, sf):
    from loanpanel.plans import queries as q
    text = plan(q.as_of(spark, sf))
    assert text.index("Generate") < text.index("array_contains(qa_field")


def test_as_of_samples_agree_on_every_path(spark, sf, monkeypatch):
    """Broadcast rates, shuffled rates and features-first draw the same rows, with the same history."""
    from loanpanel.operators import panel
    from loanpanel.plans import queries as q
    loans = q.loans(spark, sf)

    def draw(strata, exact):
        out = panel.sample_as_of(loans, fx.SOURCE, strata, 500, q.WHERE1, exact=exact, history_months=30)
        return rows(out.select(sorted(out.columns)))

    for strata in (["state", "ao_dq_cap6"], ["ao_max_dq12", "fico"]):
        for exact in (False, True):
            few = draw(strata, exact)
            with monkeypatch.context() as m:
                m.setattr(panel, "BROADCAST_ROWS", 0)
                assert draw(strata, exact) == few
            full = q.as_of(spark, sf, keep=("fico",))
            want = sampling.stratified_sample(full, strata, 500, q.KEYS1, exact=exact)
            assert {(r["loan_id"], r["ao_dt"]) for r in want.collect()} == {
                (r[0], r[1]) for r in panel.sample_as_of(
                    loans, fx.SOURCE, strata, 500, q.WHERE1, exact=exact).select("loan_id", "ao_dt").collect()}


def test_pass_one_does_not_shuffle_the_loan_table(spark, sf):
    from loanpanel.operators import panel
    from loanpanel.plans import queries as q
    text = plan(panel.sample_as_of(q.loans(spark, sf), fx.SOURCE, ["state"], 500, q.WHERE1, history_months=180))
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_digest_bounds_match_the_number(spark):
    from loanpanel.functions.expr import HASH_SPAN, digest_bound, key_digest
    rates = [0.0, 1e-9, 0.1, 0.25, 0.5, 1 - 1e-9, 1.0]
    df = spark.range(3000).withColumn("rate", F.explode(F.array(*[F.lit(r) for r in rates])))
    a = df.where(hash28("id", seed=3) < F.col("rate") * HASH_SPAN)
    b = df.where(key_digest("id", seed=3) < digest_bound(F.col("rate")))
    assert rows(a) == rows(b) and b.where("rate = 1").count() == 3000


def test_economics_agree_below_and_above_the_broadcast_limit(spark, sf):
    from loanpanel.operators import econ
    from loanpanel.plans import queries as q
    rolled = q.rolled_econ(spark, sf)
    base = stage(q.windowed(spark, sf), "base")
    few, many = (econ.join_economics(base, rolled, "zip3", q.BASE_MONTH, limit) for limit in (500_000, 0))
    assert few.columns == many.columns and rows(few) == rows(many) and few.count() > 0
    wide = base.select("zip3", "ao_dt", F.add_months("trg_dt", 600).alias("trg_dt"))
    few, many = (econ.multi_date_join(wide, rolled, {"a": "ao_dt", "t": "trg_dt"}, columns=("hpi", "month"), how="left",
                                      limit=limit) for limit in (500_000, 0))
    assert rows(few) == rows(many) and few.where("t_month IS NULL").count() == few.count()
