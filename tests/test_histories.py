"""Hand-made histories for the edges of the as-of, target and economic rules."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from loanpanel.operators.econ import economic_features
from loanpanel.operators.panel import as_of_panel
from loanpanel.operators.targets import target_pairs, target_window
from loanpanel.sources.fixtures import SECOND, SOURCE
from loanpanel.sources.tables import nest_history

MONTH = ("month date, age_fp_dt int, upb double, dq int, cur_rate double, mod string, zb string, io_rem int, "
         "bap string, program string, servicer string, reo string, pay_pl string")


def first_of(i):
    return dt.date(2015 + i // 12, i % 12 + 1, 1)


def history(dqs, zbs=None, servicers=None, skip=(), mods=None):
    rows = []
    for i, dq in enumerate(dqs):
        if i not in skip:
            rows.append((first_of(i), i, 100_000.0 - 100 * i, dq, 4.0, (mods or {}).get(i, "N"), (zbs or {}).get(i, "00"),
                         0, "N", "N", (servicers or {}).get(i, "unknown"), "N", "N"))
    return rows


def loans(spark, histories, **over):
    base = dict(loan_id=0, fp_dt=first_of(0), zip3="001", state="S1", msa="00000", msa_d="123", purpose="P", fico=700,
                ltv=80, cltv=90, num_borr=1, ppen="Y", term=360, rate=4.0, prop_val=200_000.0, fcl_pro_net=50_000.0,
                vintage="2015", bucket=1, servicer="fixed")
    base.update(over)
    flat = [(i, *row) for i, rows in enumerate(histories) for row in rows]
    tape = spark.createDataFrame(flat, "loan_id bigint, " + MONTH)
    ids = [i for i, _ in enumerate(histories)]
    static = spark.createDataFrame([(i,) for i in ids], "loan_id bigint")
    static = static.withColumns({k: F.lit(v) for k, v in base.items() if k != "loan_id"})
    empty = F.array().cast("array<string>")
    static = static.withColumns({"qa_field": empty, "all_fail": empty})
    return static.join(nest_history(tape), "loan_id")


def at(panel, month, loan=0):
    return panel.where((F.col("loan_id") == loan) & (F.col("ao_dt") == F.lit(first_of(month)))).first()


def test_lag_window_includes_its_start_and_excludes_the_as_of_month(spark):
    dqs = [0] * 20
    dqs[5], dqs[10] = 2, 4
    p = as_of_panel(loans(spark, [history(dqs)]), SOURCE)
    assert at(p, 10)["ao_max_dq12"] == 2  # the as-of month itself (dq 4) does not count
    assert at(p, 17)["ao_times60"] == 1  # month 5 is exactly 12 months before
    assert at(p, 18)["ao_times60"] == 0
    assert at(p, 18)["ao_max_dq12"] == 4 and at(p, 18)["ao_prior90p"] == "Y"
    assert at(p, 0)["ao_max_dq12"] == 0 and at(p, 0)["ao_months_cur"] == 0


def test_lag_window_skips_missing_months(spark):
    dqs = [1] * 30
    p = as_of_panel(loans(spark, [history(dqs, skip=range(6, 18))]), SOURCE)
    row = at(p, 20)
    assert row["ao_times30"] == 2  # only months 18 and 19 exist in the 12 months before
    assert at(p, 18)["ao_times30"] == 0


def test_months_current_are_counted_not_consecutive_and_capped(spark):
    p = as_of_panel(loans(spark, [history([0, 1] * 50)]), SOURCE)
    assert at(p, 11)["ao_months_cur"] == 6
    assert at(p, 99)["ao_months_cur"] == 36


def test_servicer_is_the_last_known_one_before(spark):
    names = {0: "A", 3: "B", 5: "A"}
    p = as_of_panel(loans(spark, [history([0] * 8, servicers=names)]), SOURCE)
    assert [at(p, m)["servicer"] for m in range(8)] == ["other", "A", "A", "A", "B", "B", "A", "A"]


def test_second_source_keeps_its_servicer_and_location(spark):
    p = as_of_panel(loans(spark, [history([0] * 3)]), SECOND, keep=("servicer",))
    assert at(p, 1)["servicer"] == "fixed" and at(p, 1)["msa_loc"] == "123"


def test_first_source_uses_the_state_outside_metro_areas(spark):
    assert at(as_of_panel(loans(spark, [history([0] * 3)]), SOURCE), 1)["msa_loc"] == "S1"


def test_qa_and_remaining_term(spark):
    base = loans(spark, [history([0] * 5), history([0] * 5)], term=3)
    bad = F.when(F.col("loan_id") == 1, F.array(F.lit("ltv"))).otherwise(F.array(F.lit("dti")))
    p = as_of_panel(base.withColumn("qa_field", bad), SOURCE)
    assert {r["loan_id"] for r in p.collect()} == {0}
    assert p.agg(F.max("ao_age")).first()[0] == 2  # age 3 has no remaining term


def test_where_accepts_a_leading_and(spark):
    base = loans(spark, [history([0] * 5)])
    assert as_of_panel(base, SOURCE, " and mon.dq = 0 AND ao_age > 2").count() == 2


def test_zero_rate_uses_the_floor(spark):
    base = loans(spark, [history([0] * 3)])
    zero = F.transform("monthly", lambda m: m.withField("cur_rate", F.lit(0.0)))
    p = as_of_panel(base.withColumn("monthly", zero), SOURCE)
    assert at(p, 1)["ao_r"] == pytest.approx(0.001 / 1200)


def test_pairs_run_from_the_as_of_month_to_180_months(spark):
    base = loans(spark, [history([0] * 200)])
    sample = as_of_panel(base, SOURCE, "ao_age = 5")
    months = [r["fcst_month"] for r in target_pairs(sample, base, SOURCE).collect()]
    assert sorted(months) == list(range(181))


def test_status_rules(spark):
    base = loans(spark, [history([0, 13, 2, 3], {2: "01", 3: "09"})])
    sample = as_of_panel(base, SOURCE, "ao_age = 0")
    got = {r["fcst_month"]: r for r in target_pairs(sample, base, SOURCE).collect()}
    assert [got[k]["target_status"] for k in range(4)] == [0, 12, 13, 14]
    assert [got[k]["target_death"] for k in range(4)] == [0, 0, 1, 2]


def test_expected_balance_reaches_zero(spark):
    base = loans(spark, [history([0] * 60)], term=60)
    sample = as_of_panel(base, SOURCE, "ao_age = 0")
    got = {r["fcst_month"]: r["trg_upb_exp"] for r in target_pairs(sample, base, SOURCE).collect()}
    payment = sample.first()["ao_payment"]
    assert got[59] == pytest.approx(payment / (1 + 4.0 / 1200), rel=1e-9)


def window(spark, histories, months, where=None, **kw):
    base = loans(spark, histories)
    return target_window(as_of_panel(base, SOURCE, where), base, SOURCE, months, **kw)


def test_window_events_sit_between_as_of_and_end(spark):
    out = window(spark, [history([0, 0, 0, 5, 0, 0, 0], {6: "01"}, mods={1: "Y"})], 3)
    got = {r["ao_age"]: r for r in out.collect()}
    assert [got[a]["target_dq120"] for a in range(7)] == [1, 1, 1, 1, 0, 0, 0]
    assert [got[a]["target_pp"] for a in range(7)] == [0, 0, 0, 1, 1, 1, 1]
    assert [got[a]["target_mod"] for a in range(3)] == [1, 1, 0]
    assert got[5]["l_index"] == 7 and got[5]["end_age"] == 6 and got[5]["trg_zb"] == "01"
    assert got[0]["l_index"] == 4 and got[0]["trg_age"] == 3


def test_censor_guard(spark):
    rows = [history([0] * 10), history([0] * 6)]
    assert window(spark, rows, 4).count() == 16
    kept = window(spark, rows, 4, censor_guard=True)
    assert kept.agg(F.max("ao_age")).first()[0] == 5 and kept.count() == 12


def test_window_range(spark):
    with pytest.raises(ValueError):
        window(spark, [history([0] * 3)], 61)


def economic(spark, symmetric=False, **over):
    base = dict(prop_val=100.0, rate=5.0, term=240, ao_upb=50.0, trg_upb_exp=40.0, trg_payment=1.0, ao_dq=1, fcst_month=5,
                ao_age=7, fcl_pro_net=10.0, trg_hpi=120.0, ao_hpi=110.0, org_hpi=100.0, y20_hpi=130.0, trg_fc_days=120,
                trg_income50=100.0, trg_lbr_force=1010.0, org_lbr_force=1000.0, trg_mort_fix15=3.0, trg_mort_fix30=4.0,
                org_mort_fix15=3.5, org_mort_fix30=4.5)
    base.update(over)
    df = spark.range(1).withColumns({k: F.lit(v) for k, v in base.items()})
    return economic_features(df, symmetric).first()


def test_economic_values(spark):
    r = economic(spark)
    assert r["trg_d_hpi"] == pytest.approx(20) and r["y20_prop_val"] == pytest.approx(130)
    assert r["rt15_wt"] == pytest.approx(120 / 180)
    assert r["new_rate"] == pytest.approx(2 / 3 * 3 + 1 / 3 * 4)
    assert r["trg_pti50"] == pytest.approx(12) and r["trg_fc_time"] == pytest.approx(1.5)
    assert r["trg_lbr_growth"] == pytest.approx(1200 * 10 / (1000 * 12))
    assert r["target_net_pro"] == pytest.approx(10 / 120)


def test_economic_edges(spark):
    assert economic(spark, trg_fc_days=0)["trg_fc_time"] == 1.5
    assert economic(spark, trg_fc_days=360)["trg_fc_time"] == pytest.approx(0.5)
    assert economic(spark, trg_lbr_force=100_000.0)["trg_lbr_growth"] == 25
    assert economic(spark, trg_lbr_force=1.0)["trg_lbr_growth"] == 25
    assert economic(spark, True, trg_lbr_force=1.0)["trg_lbr_growth"] == -25
    assert economic(spark, ao_age=0, fcst_month=0)["trg_lbr_growth"] == 25
    assert economic(spark, trg_income50=0.0)["trg_pti50"] == 100
    assert economic(spark, ao_dq=20)["trg_dq_max"] == 12
    assert economic(spark, trg_mort_fix15=0.0, trg_mort_fix30=0.0)["new_payment"] == pytest.approx(40 / 240)


def test_repeated_months_nest_once(spark):
    rows = history([0] * 3)
    tape = spark.createDataFrame([(0, *r) for r in rows * 3], "loan_id bigint, " + MONTH)
    assert nest_history(tape, on_repeat="largest").select(F.size("monthly")).first()[0] == 3


def test_a_profile_is_data():
    assert replace(SOURCE, static=("loan_id", "fico", "none")).narrowed(["loan_id", "fico"]).static == ("loan_id", "fico")
