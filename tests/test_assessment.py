"""All tables at once against each table on its own."""

import pytest
from pyspark.sql import functions as F

from checks.compare import differences
from loanpanel.operators import assess, assessment, network

SPECS = [("a", [1, 2], "slicer"), ("b", [0], "no_groups"), ("c", [0], "level")]
CURVES = [("a", [1, 2], "level"), ("d", [0], "feature")]


@pytest.fixture(scope="module")
def scored(spark):
    rows = spark.range(3_000).selectExpr(
        "id", "IF(id % 50 = 0, NULL, concat('k', id % 3)) AS slicer", "concat('l', id % 4) AS level",
        "IF(id % 71 = 0, NULL, (id * 7919 % 997) / 10.0D) AS feature", "CAST(id % 11 AS INT) AS age",
        "CAST(id * 31 % 3 AS INT) AS obs_class", "(id * 7 % 40) / 100.0D AS p0", "(id * 13 % 30) / 100.0D AS p1")
    return rows.withColumn("probs", F.array("p0", "p1", 1 - F.col("p0") - F.col("p1"))).repartition(5)


def plain(df, digits=9):
    kinds = dict(df.dtypes)
    return df.select(*[F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns]).toPandas()


def same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    assert differences(plain(got), plain(want)) is None


@pytest.mark.parametrize("per_task", [1_000_000, 500])
def test_same_tables_as_one_by_one(scored, per_task):
    cat, cts = ["slicer", "level"], ["feature", "age"]
    got = assessment.assess_all(scored, SPECS, ["id"], cat, cts, CURVES, per_task=per_task)
    names = set()
    for title, cols, slicer in SPECS:
        rows = network.coalesce_target(scored, cols)
        for label, by in (("overall", None), ("sliced", slicer)):
            if by != "no_groups":
                same(got[f"{title}/{label}/ks"], assess.ks(rows, by))
                same(got[f"{title}/{label}/decile"], assess.decile(rows, ["id"], by))
                names |= {f"{title}/{label}/ks", f"{title}/{label}/decile"}
        same(got[f"{title}/segment"], assess.segment(rows, [c for c in cat if c != slicer], cts, slicer))
        same(got[f"{title}/range"], assess.axis_range(rows, slicer))
        names |= {f"{title}/segment", f"{title}/range"}
    for title, cols, slicer in CURVES:
        same(got[f"{title}/curves"], assess.curves(network.coalesce_target(scored, cols), slicer, slicer in cts))
        names.add(f"{title}/curves")
    assert set(got) == names


def test_regression_tables_far_from_zero(scored):
    """A target with a large mean keeps its intervals."""
    rows = scored.withColumns({"fit": F.col("age") + 1e9, "obs": 1e9 + F.col("age") + F.col("id") % 2})

    def seen(df, _):
        return df

    got = assessment.assess_all(rows, [("r", [0], "level")], ["id"], ["slicer"], ["feature"], view=seen, regression=True)
    for label, by in (("overall", None), ("sliced", "level")):
        want = assess.r_squared(rows.withColumns({"fit": F.col("fit") - 1e9, "obs": F.col("obs") - 1e9}), by)
        assert differences(plain(got[f"r/{label}/r2"], 4), plain(want, 4)) is None
    small = rows.withColumns({"fit": F.col("fit") - 1e9, "obs": F.col("obs") - 1e9})
    want = assess.decile(small, ["id"], "level").select(
        "slice", "decile", "n", *[(F.col(c) + (1e9 if c != "avg_fit" else 1e9)).alias(c) for c in ("avg_fit", "avg_obs", "low", "high")])
    assert differences(plain(got["r/sliced/decile"], 4), plain(want, 4)) is None


def test_no_specs_and_no_rows(scored):
    assert assessment.assess_all(scored, [], ["id"], [], []) == {}
    got = assessment.assess_all(scored.limit(0), SPECS, ["id"], ["level"], ["feature"], CURVES)
    assert all(table.count() == 0 for table in got.values())
