"""Networks, fits, bias correction and saved definitions."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from loanpanel.operators import assess, assessment, calibrate, features, models, network, quasi_newton, training
from loanpanel.plans.job import Job, run
from loanpanel.plans.queries import FIXED_NET
from loanpanel.sources import fixtures as fx
from loanpanel.sources.tables import write_sorted


@pytest.fixture(scope="module")
def loans(spark, sf):
    return fx.staged(spark, sf, "loans").withColumn("y", F.when(F.col("fico") + F.col("ltv") > 780, "hi").otherwise("lo"))


def dense(net, defs, x):
    """The network's output by plain products over one-hot blocks."""
    n, width = len(net.cts), sum(defs.n_levels[c] for c in net.cat)
    blocks = np.zeros((len(x), width))
    for j in range(len(net.cat)):
        blocks[np.arange(len(x)), x[:, n + j].astype(int)] = 1.0
    h = np.hstack([x[:, :n], blocks])
    for w, b, act in net.layers:
        h = network._activate(h @ np.asarray(w) + np.asarray(b), act)
    return h


def test_levels_enter_as_rows_of_the_first_layer(spark, loans):
    defs = features.fit_features(loans, ["fico", "ltv"], ["purpose", "state", "y"])
    table = models.design_table(loans, defs, ["fico", "ltv"], ["purpose", "state"], "y", "cat")
    assert table.where(F.size("x") != 4).isEmpty()  # no more numbers than features
    net = training.start_network(["fico", "ltv"], ["purpose", "state"], {}, defs.n_levels, [(3, "sigmoid"), (2, "softmax")], 1)
    got = table.withColumn("q", network.network_output(net, "x", spark)).toPandas()
    assert np.allclose(dense(net, defs, np.stack(got["x"])), np.stack(got["q"]))


@pytest.mark.parametrize("kind", ["cat", "cts"])
def test_steps_end_at_the_weights_of_the_public_fit(spark, loans, kind):
    """Penalized softmax and linear fits have one optimum; unpenalized ones without levels too, centred over the classes."""
    rows = loans.withColumn("t", F.col("fico") * 0.3 - F.col("ltv") + F.col("rate"))
    target = "y" if kind == "cat" else "t"
    for cat, l2 in ((["purpose"], 1e-2), ([], 1e-3)):
        fitted = models.fit_model(rows, target, kind, ["rate", "ltv"], cat, l2=l2, max_iter=200, tol=1e-12)
        table = models.design_table(rows, fitted.defs, ["rate", "ltv"], cat, target, kind)
        width = fitted.defs.n_levels.get("purpose", 0) if cat else 0
        vectors = table.select(array_to_vector(F.concat(F.slice("x", 1, 2), *[F.transform(
            F.sequence(F.lit(0), F.lit(width - 1)), lambda k: (k == F.col("x")[2]).cast("double"))] * bool(cat))).alias("features"),
            F.col("y").alias("label"))
        if kind == "cat":
            m = LogisticRegression(family="multinomial", regParam=l2, maxIter=500, tol=1e-14, standardization=False).fit(vectors)
            want = (m.coefficientMatrix.toArray().T, m.interceptVector.toArray())
        else:
            m = LinearRegression(regParam=l2, maxIter=500, tol=1e-14, standardization=False, solver="l-bfgs").fit(vectors)
            want = (m.coefficients.toArray()[:, None], np.array([m.intercept]))
        (w, b, _), = fitted.net.layers
        assert np.allclose(w, want[0], atol=1e-6) and np.allclose(b, want[1], atol=1e-6)


def test_every_step_has_both_costs_and_patience_ends_the_fit(spark, loans):
    train, valid, _ = features.bucket_split(loans)
    noise = valid.withColumn("y", F.when(F.pmod(F.xxhash64("loan_id"), F.lit(2)) == 0, "hi").otherwise("lo"))
    fitted = models.fit_model(train, "y", "cat", ["fico", "ltv"], ["state"], noise, max_iter=80, patience=3)
    steps, held = [c[0] for c in fitted.costs], [c[2] for c in fitted.costs]
    assert steps == list(range(len(steps))) and None not in held and len(steps) < 60
    assert fitted.best_step == int(np.argmin(held)) and steps[-1] == fitted.best_step + 3
    table = models.design_table(noise, fitted.defs, ["fico", "ltv"], ["state"], "y", "cat")
    assert models.cost(table, fitted.net, "cat") == pytest.approx(min(held), abs=1e-9)  # the best step's weights are kept
    falling = [c[1] for c in fitted.costs]
    assert all(a >= b for a, b in zip(falling, falling[1:]))


def test_a_step_is_one_job(spark, loans):
    table = models.design_table(loans, features.fit_features(loans, ["fico"], ["y"]), ["fico"], [], "y", "cat")
    rows = table.select("x", "y", F.lit(False).alias("held"))
    net = training.start_network(["fico"], [], {}, {"y": 2}, [(4, "relu"), (2, "softmax")], 3)
    calls = []
    start = training.pack(net)

    def evaluated(points):
        calls.append(len(points))
        return quasi_newton.evaluate(rows, net, "cat", np.zeros_like(start), points)

    seen = []
    quasi_newton.minimize(evaluated, start, 12, 1e-9, lambda step, point: seen.append(point.cost) or True)
    assert len(calls) <= len(seen) + 3 and seen[-1] < seen[0]


def test_full_batch_network_does_not_depend_on_partitions(spark):
    rows = spark.range(600).selectExpr("id", "(id % 97) / 10.0 AS x", "id % 3 AS g", "IF(id % 97 > 40, 'a', 'b') AS y")
    fits = [models.fit_network(rows.repartition(n, "id"), "y", "cat", ["x"], [], [(4, "sigmoid")], {"g": 2}, epochs=6) for n in (1, 7)]
    assert np.allclose([c[1] for c in fits[0].costs], [c[1] for c in fits[1].costs], atol=1e-9)
    assert np.allclose(training.pack(fits[0].net), training.pack(fits[1].net), atol=1e-6)


def test_quasi_newton_on_a_valley():
    def evaluated(points):
        return [quasi_newton.Point(p, (1 - p[0]) ** 2 + 100 * (p[1] - p[0] ** 2) ** 2,
                                   np.array([-2 * (1 - p[0]) - 400 * p[0] * (p[1] - p[0] ** 2), 200 * (p[1] - p[0] ** 2)]), 0.0, None)
                for p in points]

    end = quasi_newton.minimize(evaluated, np.array([-1.2, 1.0]), 200, 1e-9, lambda step, point: True)
    assert np.allclose(end.weights, [1, 1], atol=1e-8)


def test_few_levels_are_found_as_by_the_join(spark, monkeypatch):
    rows = spark.createDataFrame([(k, "abc"[k % 3] if k % 5 else None, k % 4) for k in range(40)], "id int, s string, g int")
    other = rows.unionByName(spark.createDataFrame([(90, "z", 9), (91, None, None)], rows.schema))
    listed = features.apply_features(other, features.fit_features(rows, [], ["s", "g"]))
    assert "Join" not in listed._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(features, "LISTED_LEVELS", 0)
    joined = features.apply_features(other, features.fit_features(rows, [], ["s", "g"]))
    assert sorted(listed.collect(), key=str) == sorted(joined.collect(), key=str)


def test_softmax_fit_beats_the_base_rate_and_survives_saving(spark, loans, tmp_path):
    fitted = models.fit_model(loans, "y", "cat", ["fico", "ltv"], ["purpose"], loans, max_iter=50)
    assert fitted.costs[-1][1] < 0.5
    fitted.save(spark, str(tmp_path / "m"))
    back = models.Fitted.load(spark, str(tmp_path / "m"))
    a = network.score_network(loans, fitted.net, fitted.defs).orderBy("loan_id").select("probs").collect()
    b = network.score_network(loans, back.net, back.defs).orderBy("loan_id").select("probs").collect()
    assert a == b and back.defs.defaults == fitted.defs.defaults


def test_hidden_layers_stop_and_continue(spark, loans):
    train, valid, _ = features.bucket_split(loans)
    first = models.fit_model(train, "y", "cat", ["fico", "ltv"], [], valid, [3], max_iter=40, patience=5)
    assert first.costs[-1][0] <= 40 and first.best_step in [c[0] for c in first.costs]
    more = models.fit_model(train, "y", "cat", ["fico", "ltv"], [], valid, [3], max_iter=5, patience=5, start_from=first)
    best = first.costs[first.best_step]
    assert more.costs[0][0] == 0 and more.costs[0][1:] == pytest.approx(best[1:], abs=1e-9)
    assert first.cost_table(spark).where("best").count() == 1


def test_linear_fit_recovers_a_line(spark, loans):
    rows = loans.withColumn("t", 3.0 * F.col("fico") - 2.0 * F.col("ltv") + 1.0)
    fitted = models.fit_model(rows, "t", "cts", ["fico", "ltv"], [])
    scored = network.continuous_target(network.score_network(rows, fitted.net, fitted.defs), "t", fitted.defs.stats)
    assert assess.r_squared(scored).first()["r2"] == pytest.approx(100, abs=1e-4)


def test_fit_rejects_what_it_cannot_do(loans):
    for kw in ({"kind": "cts", "hidden": [2]}, {"kind": "cat", "hidden": [2], "l2": 0.1}, {"kind": "other"}):
        with pytest.raises(ValueError):
            models.fit_model(loans, "y", cts=["fico"], cat=[], **kw)


def test_bias_fit_reaches_class_rates(spark, sf):
    scored = fx.staged(spark, sf, "scored")
    shift, errors = calibrate.fit_bias(scored, 3)
    assert errors[-1] < 1e-12 and len(errors) <= 11
    row = calibrate.apply_bias(scored, shift).agg(
        *[F.avg(F.col("probs")[j]) for j in range(3)], *[F.avg((F.col("obs_class") == j).cast("int")) for j in range(3)]
    ).first()
    assert row[:3] == pytest.approx(row[3:], abs=1e-6)


def test_bias_in_the_network_equals_bias_on_probabilities(spark, loans):
    defs = features.fit_features(loans, FIXED_NET.cts, FIXED_NET.cat)
    plain = network.score_network(loans, FIXED_NET, defs)
    a = calibrate.apply_bias(plain, [0.7]).orderBy("loan_id").select("probs").toPandas()["probs"]
    moved = network.score_network(loans, FIXED_NET.with_bias([0.7]), defs)
    b = moved.orderBy("loan_id").select("probs").toPandas()["probs"]
    assert np.allclose(np.stack(a), np.stack(b))


def test_bias_errors(spark):
    def df(p):
        return spark.createDataFrame([(p, 0), ([0.5, 0.5], 1)], "probs array<double>, obs_class int")
    with pytest.raises(ValueError):
        calibrate.fit_bias(df([1.0, 0.0]), 2)
    with pytest.raises(ValueError):
        calibrate.fit_bias(df([0.4, 0.6]).where("obs_class = 0"), 2)
    with pytest.raises(ValueError):
        calibrate.fit_bias(df([0.4, 0.6]), 1)


def test_ks_is_a_percentage_and_zero_for_a_constant(spark, sf):
    rows = network.coalesce_target(fx.staged(spark, sf, "scored"), [0])
    assert 0 <= assess.ks(rows).first()["ks"] <= 100
    assert assess.ks(rows.withColumn("fit", F.lit(0.5))).first()["ks"] == pytest.approx(0)


def test_numeric_levels_sort_by_value(spark):
    df = spark.createDataFrame([(10,), (9,), (9,), (100,)], "k int")
    got = features.level_index(df, ["k"]).orderBy("idx").collect()
    assert [r["level"] for r in got] == ["9", "10", "100"] and got[0]["is_default"]


def test_target_levels_sort(spark):
    df = spark.createDataFrame([("no",), ("yes",), ("maybe",)], "t string")
    assert {r["level"]: r["idx"] for r in features.level_index(df, ["t"]).collect()} == {"maybe": 0, "no": 1, "yes": 2}


def test_needed_columns():
    assert features.needed_columns(["b", "a", "p"], "t", ["a"], ["k"], [], ["p"]) == ["a", "b", "k", "t"]


def test_sorted_write(spark, loans, tmp_path):
    write_sorted(loans.drop("monthly"), str(tmp_path / "t"), "loan_id", 4)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == loans.count()
    spans = back.groupBy(F.input_file_name()).agg(F.min("loan_id").alias("a"), F.max("loan_id").alias("b")).orderBy("a")
    got = spans.collect()
    assert len(got) > 1 and all(x["b"] <= y["a"] for x, y in zip(got, got[1:]))


def test_a_job_needs_a_phase(spark, tmp_path):
    with pytest.raises(ValueError):
        run(spark, Job("empty", str(tmp_path)))
    with pytest.raises(ValueError):
        run(spark, Job("no model", str(tmp_path), bias=spark.range(1)))


def test_slicing_on_a_continuous_feature_is_refused(spark, sf):
    rows = network.coalesce_target(fx.staged(spark, sf, "scored"), [0])
    with pytest.raises(ValueError):
        assessment.assess_all(rows, [("x", [0], "feature")], ["id"], ["level"], ["feature"])


def test_many_levels_are_numbered_like_few(spark, sf):
    orders = fx.table(spark, sf, "orders")
    cat = ["o_custkey", "o_orderpriority", "o_totalprice"]
    few = features.level_index(orders, cat).orderBy("feature", "idx").collect()
    assert features.level_index(orders, cat, per_task=200).orderBy("feature", "idx").collect() == few


def test_nested_input_columns():
    inner = network.InputModel(FIXED_NET, None, {"a": [0]})
    outer = network.InputModel(network.Network(["a", "dti"], [], []), None, {"b": [0]}, [inner])
    assert network.input_columns([outer]) == ({"fico", "ltv", "num_borr", "dti"}, {"a", "b"})


@pytest.mark.parametrize("is_cat", [True, False])
def test_batch_gradient_by_differences(is_cat):
    rng = np.random.default_rng(0)
    net = training.start_network(["a", "b"], [], {"e": 2}, {"e": 3}, [(4, "sigmoid"), (3, "leaky_relu"),
                                 (2, "softmax") if is_cat else (1, "linear")], 5)
    shapes, acts = training._form(net)
    flat = training.pack(net) + rng.normal(0, 0.1, training.pack(net).shape)
    x = np.column_stack([rng.normal(size=(20, 2)), rng.integers(0, 3, 20)])
    y = rng.integers(0, 2, 20).astype(float)
    _, grad = training.batch_gradient(flat, shapes, acts, x, y, is_cat)
    for i in range(len(flat)):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        loss = [training.batch_gradient(f, shapes, acts, x, y, is_cat)[0] / 20 for f in (up, down)]
        assert grad[i] == pytest.approx((loss[0] - loss[1]) / 2e-6, abs=1e-5)


def test_network_regression_learns_a_bend_and_continues(spark):
    rows = spark.range(3000).withColumn("x", (F.col("id") % 100 - 50) / 25.0).withColumn("y", F.abs("x"))
    rows = rows.repartition(4, "id")
    line = models.fit_model(rows, "y", "cts", ["x"], [])
    bend = models.fit_network(rows, "y", "cts", ["x"], [], [(8, "relu")], valid=rows, epochs=60, batch=1000,
                              rates=(0.05, 0.01), patience=5)
    assert line.costs[0][1] > 0.9 and min(c[2] for c in bend.costs) < 0.3
    more = models.fit_network(rows, "y", "cts", ["x"], [], [], epochs=2, batch=1000, rates=(1e-3, 1e-4), start_from=bend)
    assert more.costs[-1][1] < 0.3


def test_network_learns_through_an_embedding(spark):
    rows = spark.range(2000).withColumn("g", F.concat(F.lit("k"), F.col("id") % 10))
    rows = rows.withColumn("y", F.when(F.col("id") % 10 < 3, "a").otherwise("b")).repartition(4, "id")
    fit = models.fit_network(rows, "y", "cat", [], [], [(4, "relu")], {"g": 2}, epochs=60, batch=1000, rates=(0.05, 0.01), l2=1e-6)
    assert fit.costs[-1][1] < 0.1 and fit.net.emb == ["g"] and len(fit.net.tables[0]) == 10
    scored = network.score_network(rows, fit.net, fit.defs)
    assert scored.where((F.col("probs")[0] > 0.5) != (F.col("y") == "a")).isEmpty()


def test_costs_are_those_of_the_fit_and_survive_saving(spark, tmp_path):
    rows = [(float(k % 50), "hi" if (k * 7919) % 100 < k % 50 + 25 else "lo") for k in range(400)]
    train = spark.createDataFrame(rows, "x double, y string")
    fitted = models.fit_model(train, "y", "cat", ["x"], [], train, max_iter=60)
    steps = [c[0] for c in fitted.costs]
    assert steps == list(range(len(steps))) and 1 < len(steps) <= 61
    assert fitted.costs[0][1] > fitted.costs[-1][1] and fitted.best_step == steps[-1]
    fitted.save(spark, str(tmp_path / "m"))
    again = models.Fitted.load(spark, str(tmp_path / "m"))
    assert again.costs == fitted.costs and again.cost_table(spark).where("best").count() == 1


def test_unknown_classes_are_refused_and_missing_targets_left_out(spark):
    train = spark.createDataFrame([(float(k), "ab"[k % 2] if k % 9 else None) for k in range(90)], "x double, y string")
    fitted = models.fit_model(train, "y", "cat", ["x"], [])
    assert fitted.defs.n_levels["y"] == 2
    other = spark.createDataFrame([(1.0, "c")], "x double, y string")
    with pytest.raises(ValueError, match="1 rows have a y"):
        models.fit_model(train, "y", "cat", ["x"], [], other)


def test_network_fit_does_not_depend_on_partitions(spark):
    rows = spark.range(600).selectExpr("id", "(id % 97) / 10.0 AS x", "id % 3 AS g", "IF(id % 97 > 40, 'a', 'b') AS y")
    rows = rows.unionByName(rows.where("id < 5").crossJoin(spark.range(60).select()))  # rows that repeat
    fits = [models.fit_network(rows.repartition(n, "id"), "y", "cat", ["x"], [], [(4, "relu")], {"g": 2}, epochs=3,
                               batch=300, rates=(0.05, 0.05)) for n in (1, 4, 16)]
    for other in fits[1:]:
        assert np.allclose(training.pack(other.net), training.pack(fits[0].net), atol=1e-9)
        assert np.allclose([c[1] for c in other.costs], [c[1] for c in fits[0].costs], atol=1e-9)


def test_batches_hold_all_copies_evenly(spark):
    table = spark.range(1000).selectExpr("array(double(IF(id < 400, 0, id))) AS x", "0.0D AS y",
                                         "xxhash64(IF(id < 400, 0, id)) AS key")
    dealt, n = training.in_batches(table, 100)
    sizes = {r["batch"]: r["n"] for r in dealt.groupBy("batch").agg(F.sum("copies").alias("n")).collect()}
    assert n == 10 and sum(sizes.values()) == 1000 and set(sizes) == set(range(10))
    hot = dealt.where("x[0] = 0").select("batch", "copies").collect()
    assert {(r["batch"], r["copies"]) for r in hot} == {(b, 40) for b in range(10)}
