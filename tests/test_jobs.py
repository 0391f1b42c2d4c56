"""Whole jobs: data, fit, bias correction, assessment, exports."""

import pytest
from pyspark.sql import functions as F

from loanpanel.operators import features, network
from loanpanel.operators.models import Fitted
from loanpanel.plans import queries as q
from loanpanel.plans.job import AssessBlock, DataBlock, Job, ModelBlock, Stage, run
from loanpanel.sources import fixtures as fx


@pytest.fixture(scope="module")
def table(spark, sf, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("data"))
    block = DataBlock(
        fx.staged(spark, sf, "loans"), fx.SOURCE, fx.staged(spark, sf, "econ"),
        Stage(["state", "ao_dq_cap6"], 2000, q.WHERE1, f"{base}/pass1", f"{base}/strata1"),
        Stage(["target_status"], 1500, "fcst_month > 0", f"{base}/pass2", f"{base}/strata2"),
        f"{base}/out", base_month=q.BASE_MONTH, sort_key="loan_id", exact=True, **q.ERA)
    out = run(spark, Job("data", base, data=block)).data
    first, strata = spark.read.parquet(f"{base}/pass1"), spark.read.parquet(f"{base}/strata1")
    assert first.count() == 2000 and "ao_max_dq12" in first.columns
    assert strata.agg(F.sum("expected")).first()[0] == pytest.approx(2000)
    assert spark.read.parquet(f"{base}/pass2").count() == 1500
    assert set(spark.read.parquet(f"{base}/strata2").columns) == {"target_status", "n", "rate", "expected"}
    return out


def test_economic_columns_are_all_there(table):
    names = [f"{p}_{c}" for p in ("trg", "ao", "org", "y20") for c in q.econ.ECON_COLUMNS]
    assert set(names) <= set(table.columns) and "msa_loc_name" in table.columns


def test_model_with_an_input_model_bias_and_assessment(spark, table, tmp_path):
    table = table.withColumn("bad", F.when(F.col("target_dq") >= 4, 1).otherwise(0))
    inner_net = network.Network(["fico"], [], [([[0.5, -0.5]], [0.1, 0.0], "softmax")])
    inner = network.InputModel(inner_net, features.fit_features(table, ["fico"], []), {"lo_first": [0]})
    model, valid, held = features.bucket_split(table)
    job = Job(
        "full", str(tmp_path), input_models=[inner], keep=["loan_id"],
        model=ModelBlock(model, "bad", "cat", ["lo_first", "ao_age"], ["ao_dq_cap6"], valid, l2=1e-4, max_iter=20),
        bias=table,
        assess=AssessBlock(held, q.KEYS2, [("bad", [1], "ao_dq_cap6")], [("bad", [1], "trg_yr_qtr"), ("bad", [1], "ao_upb")],
                           extra_features=["ao_upb"], extra_cat=["purpose"], save_to=str(tmp_path / "scored"),
                           save_outputs={"p_bad": [1], "p_all": [0, 1]}, marginals=True))
    got = run(spark, job)
    assert set(got.fitted.net.features) == {"lo_first", "ao_age", "ao_dq_cap6"} and len(got.shift) == 1
    saved = spark.read.parquet(str(tmp_path / "scored"))
    assert saved.where("abs(p_all - 1) > 1e-9").isEmpty() and "loan_id" in saved.columns and "probs" not in saved.columns
    scored = network.score_network(network.add_input_models(table, [inner]), got.fitted.net, got.fitted.defs)
    mean, rate = scored.agg(F.avg(F.col("probs")[1]), F.avg("bad")).first()
    assert mean == pytest.approx(rate, abs=1e-5)
    back = Fitted.load(spark, str(tmp_path / "model-bias"))
    assert back.net.layers == got.fitted.net.layers
    for name in ("bad/curves", "bad/overall/ks", "bad/sliced/decile", "bad/segment", "bad/range", "bad/marginal/ao_upb",
                 "bad/marginal/purpose/distribution"):
        assert got.tables[name].count() > 0, name
    seen = {r["feature"] for r in got.tables["bad/segment"].select("feature").distinct().collect()}
    assert seen == {"lo_first", "ao_age", "ao_upb", "purpose"}


def test_regression_job(spark, table, tmp_path):
    model, _, held = features.bucket_split(table)
    got = run(spark, Job(
        "line", str(tmp_path), model=ModelBlock(model, "ao_payment", "cts", ["ao_upb", "ao_rate"], ["purpose"]),
        assess=AssessBlock(held, q.KEYS2, [("pay", [0], "purpose")], marginals=True)))
    assert got.tables["pay/overall/r2"].first()["r2"] > 30
    assert got.tables["pay/marginal/ao_upb"].agg(F.max("median")).first()[0] > 10  # back on the scale of the target
    assert not any(name.endswith("/ks") for name in got.tables)
