"""Draws from all pairs of a book: digests on whole arrays against Spark's, and the drawn rows against a draw from the exploded pairs."""

import datetime as dt
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanpanel.functions.expr import key_digest
from loanpanel.operators import digests, sampling, targets
from loanpanel.plans import queries as q
from loanpanel.sources import fixtures as fx
from loanpanel.sources.tables import stage

KEYS = ["loan_id", "ao_dt", "trg_dt"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("size", [0, 3, 31, 55, 56, 64, 119, 120, 200])
def test_digits_of_texts_of_any_length(size):
    texts = np.random.default_rng(size).integers(0, 256, (5, size), np.uint8)
    padded = [t.tobytes() + b"\x80" + b"\0" * ((55 - size) % 64) + (8 * size).to_bytes(8, "little") for t in texts]
    words = np.stack([np.frombuffer(p, "<u4") for p in padded], 1)
    want = [hashlib.md5(t.tobytes()).hexdigest()[:8] for t in texts]
    assert [f"{d:08x}" for d in digests.first_digits(list(words), 5)] == want


@pytest.mark.parametrize("chunk", [7, 32_768])
@pytest.mark.parametrize("name", ["id", "concat('loan ', id * id * id)", "IF(id % 3 = 0, '', repeat('é', CAST(id AS INT)))"])
def test_low_pairs_are_those_of_the_key_digest(spark, monkeypatch, name, chunk):
    monkeypatch.setattr(digests, "CHUNK", chunk)
    month = F.add_months(F.lit(dt.date(1999, 11, 1)), (F.col("id") % 4).cast("int") + F.col("k"))
    entries = spark.range(40).join(spark.range(9).select(F.col("id").cast("int").alias("k")).where("k <> 4")).where(
        "id % 8 <> 5").select("id", F.expr(name).alias("loan_id"), month.alias("month"))
    book = entries.groupBy("id", "loan_id").agg(F.sort_array(F.collect_list("month")).alias("months"))
    book = book.unionByName(spark.sql("SELECT 99L AS id, CAST(NULL AS ARRAY<DATE>) AS months").withColumn(
        "loan_id", F.lit("99").cast(book.schema["loan_id"].dataType)))
    apart = F.months_between("trg_dt", "ao_dt")
    pairs = entries.withColumnRenamed("month", "ao_dt").join(entries.withColumnRenamed("month", "trg_dt"), ["id", "loan_id"])
    pairs = pairs.where(apart.between(0, 6)).select(*KEYS)
    for bound in ("4000000", "0000000", "fffffff"):
        got = digests.low_pairs(book, bound, 6, 10)
        assert rows(got) == rows(pairs.where(key_digest(*KEYS, seed=10) < bound)) and got.count() > 0 or bound == "0000000"


def test_dates_of_other_lengths_are_left_to_the_exact_draw(spark):
    book = spark.sql("SELECT 1 AS loan_id, array(DATE'2000-01-01', DATE'+10000-01-01') AS months")
    got = digests.low_pairs(book, "0000000", 200_000, 10).select("loan_id", F.year("ao_dt"), F.year("trg_dt"))
    spark_rows = [tuple(r) for r in got.collect()]
    assert sorted(spark_rows) == [(1, 2000, 10000), (1, 10000, 10000)]


def odd_book(spark, sf):
    base = q.loans(spark, sf)
    again = base.where("loan_id % 20 = 0").withColumns({"fico": F.lit(1), "monthly": F.slice("monthly", 3, 100)})
    rejected = base.where("loan_id % 30 = 1").withColumn("qa_field", F.array(F.lit("fico")))
    none = base.where("loan_id % 7 = 0").withColumn("loan_id", F.lit(None).cast("bigint"))
    return stage(base.unionByName(again).unionByName(rejected).unionByName(none), "odd-book")


@pytest.mark.parametrize("n,few", [(400, True), (400, False), (10 ** 9, True), (0, True)])
@pytest.mark.parametrize("strata,where", [(["target_status"], None), (["trg_zb", "periods"], q.WHERE2 + " AND ao_age > 3")])
def test_a_draw_from_a_book_is_that_from_its_pairs(spark, sf, monkeypatch, n, few, strata, where):
    book, seen = odd_book(spark, sf), []
    monkeypatch.setattr(targets, "stage", lambda df, label: seen.append(label) or stage(df, label))

    def unfolded(part):
        return targets.with_history(part, fx.SOURCE, q.WHERE1)

    got, rates = targets.draw_targets(unfolded(book), fx.SOURCE, strata, n, where, **({"book": book, "unfold": unfolded} if few else {}))
    pairs = stage(targets.explode_targets(unfolded(book), fx.SOURCE, where), "pairs")
    want = sampling.stratified_sample(pairs, strata, n, KEYS).select(*KEYS).distinct()
    names = [c for c in got.columns if c in pairs.columns]
    assert rows(got.select(*names)) == rows(pairs.join(want, KEYS, "left_semi").select(*names))
    assert rows(rates) == rows(sampling.strata_rates(pairs, strata, n).select(*rates.columns))
    assert ("low-pairs" in seen) == (few and n < 10 ** 9)


def test_the_balanced_draw_unfolds_few_loans_again(spark, sf, monkeypatch):
    kept = {}
    monkeypatch.setattr(q, "N2", 40)
    monkeypatch.setattr(targets, "stage", lambda df, label: kept.setdefault(label, stage(df, label)))
    got = q.all_queries()["balanced_target_sample"](spark, sf)
    assert 0 < got.count() <= kept["low-pairs"].count() < q.pairs(spark, sf).count() / 20
    assert kept["low-loans"].count() == kept["low-pairs"].select("loan_id").distinct().count()


def test_a_choice_of_few_pairs_is_not_looked_for_among_too_many(spark, sf):
    """The sample is small, but the pairs of the whole book below its bound are not."""
    months = targets.book_months(odd_book(spark, sf))
    rates = spark.createDataFrame([("a", 20, 0.4)], "s string, n long, rate double")
    assert targets._low_bound(rates, months) == "6666667"
    many = months.select("loan_id", F.explode(F.sequence(F.lit(1), F.lit(20))), "months")
    assert targets._low_bound(rates, many) is None
