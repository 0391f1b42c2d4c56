"""Loan, economic and scored tables derived from the order tables.

The reference data is not public, so a loan book is read out of customers and
their orders: a customer is a loan, months since the last order are its
delinquency, lifetime spend not yet reached is its balance, and the status of
the last order is its exit.  Money is summed in integer cents, which makes
running sums exact.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanpanel.functions.expr import hash28, month_index, months_apart
from loanpanel.sources.profile import PAY_PLAN, PLAN_CODE
from loanpanel.sources.tables import nest_history, stage

STATIC = ("loan_id", "fp_dt", "zip3", "state", "msa", "purpose", "fico", "ltv", "cltv", "num_borr", "ppen", "term",
          "rate", "prop_val", "fcl_pro_net", "vintage", "bucket")
SOURCE = replace(PLAN_CODE, static=STATIC)
SECOND = replace(PAY_PLAN, static=tuple("msa_d" if c == "msa" else c for c in (*STATIC, "servicer")))
MONTHS_PER_TASK = 50_000  # order months, which unfold to some seven times as many months of a tape
ZIPS_PER_TASK = 20_000  # each has a row per month of seven years
ECON_FIRST, ECON_LAST = "1995-01-01", "2001-12-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_months(orders: DataFrame) -> DataFrame:
    """(customer, month): cents spent, last status and priority; partial sums run before the shuffle."""
    return orders.groupBy(
        F.col("o_custkey").alias("loan_id"), F.trunc("o_orderdate", "MM").alias("month")
    ).agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
        # Codes, not strings: a maximum of numbers stays in the hash aggregate.
        F.max(F.ascii("o_orderstatus")).alias("st"),
        F.max(F.ascii("o_orderpriority")).alias("pr"),
    )


def static_loans(spark: SparkSession, sf_dir: str, months: DataFrame) -> DataFrame:
    books = months.groupBy("loan_id").agg(
        F.min("month").alias("fp_dt"), F.max("month").alias("last_dt"), F.sum("cents").alias("tot"))
    k, nat = F.col("loan_id"), F.col("c_nationkey")
    no_names = F.array().cast("array<string>")
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "loan_id").hint("shuffle_hash")
    joined = books.join(customers, "loan_id")
    return joined.select(
        "loan_id", "fp_dt", "last_dt",
        F.lpad(nat.cast("string"), 3, "0").alias("zip3"),
        F.concat(F.lit("S"), nat.cast("string")).alias("state"),
        F.when(nat % 5 == 0, "00000").otherwise(F.lpad((nat * 7).cast("string"), 5, "0")).alias("msa"),
        F.col("c_mktsegment").alias("purpose"),
        (600 + k % 200).cast("int").alias("fico"),
        (60 + k % 40).cast("int").alias("ltv"),
        (60 + k % 40 + F.when(k % 4 == 0, 10).otherwise(0)).cast("int").alias("cltv"),
        (1 + k % 2).cast("int").alias("num_borr"),
        F.when(k % 6 == 0, "Y").otherwise("N").alias("ppen"),
        F.when(k % 3 == 0, 180).when(k % 3 == 1, 240).otherwise(360).alias("term"),
        (3.0 + (k % 40) / F.lit(10.0)).alias("rate"),
        (F.col("tot") / F.lit(100.0) * 1.25).alias("prop_val"),
        (F.col("tot") / F.lit(100.0) * (k % 11) / F.lit(10.0)).alias("fcl_pro_net"),
        F.year("fp_dt").cast("string").alias("vintage"),
        F.pmod(F.conv(F.substring(F.md5(k.cast("string")), 1, 7), 16, 10).cast("bigint"), F.lit(20))
        .cast("int").alias("bucket"),
        F.when(k % 17 == 0, F.array(F.lit("fico"))).when(k % 19 == 0, F.array(F.lit("dti")))
        .otherwise(no_names).alias("qa_field"),
        F.when(k % 23 == 0, F.array(F.lit("dq"))).otherwise(no_names).alias("all_fail"),
    )


def flat_tape(months: DataFrame) -> DataFrame:
    """(loan, month) tape: every order month is repeated until the next one.

    Windows run per loan over at most one row per calendar month.
    """
    whole = Window.partitionBy("loan_id")
    ordered = whole.orderBy("month")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    known = months.select(
        "loan_id", "cents", "st",
        F.col("month").alias("ordered"),
        F.min("month").over(whole).alias("fp"),
        F.max("month").over(whole).alias("lp"),
        (F.sum("cents").over(whole) - F.sum("cents").over(so_far)).alias("left"),
        F.max(F.when(F.col("pr") == ord("5"), 1).otherwise(0)).over(so_far).alias("low"),
        F.add_months(F.coalesce(F.lead("month").over(ordered), F.add_months("month", 1)), -1).alias("until"),
    )
    k = F.col("loan_id")
    calendar = known.withColumn("month", F.explode(F.sequence("ordered", "until", F.expr("interval 1 month"))))
    return calendar.select(
        "loan_id", "month",
        months_apart("fp", "month").cast("int").alias("age_fp_dt"),
        (F.col("left") / F.lit(100.0)).alias("upb"),
        months_apart("ordered", "month").cast("int").alias("dq"),
        F.when(k % 13 == 0, 0.0).otherwise(3.0 + (k % 40) / F.lit(10.0)).alias("cur_rate"),
        F.when((k % 5 == 0) & (F.col("low") == 1), "Y").otherwise("N").alias("mod"),
        F.when(F.col("month") < F.col("lp"), "00").when(F.col("st") == ord("F"), "01")
        .when((F.col("st") == ord("P")) & (k % 2 == 0), "03").when(F.col("st") == ord("P"), "09")
        .otherwise("00").alias("zb"),
        F.lit(0).alias("io_rem"),
        F.when(k % 7 == 0, "T").otherwise("N").alias("bap"),
        F.lit("N").alias("program"),
        F.when(F.col("month") > F.col("ordered"), "unknown")
        .otherwise(F.concat(F.lit("SV"), (F.col("cents") % 5).cast("string"))).alias("servicer"),
        F.lit("N").alias("reo"),
        F.when(k % 7 == 0, "Y").otherwise("N").alias("pay_pl"),
    )


def nested_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans with their history.  One shuffle of the order months serves all that follows, in tasks of a bounded number of months.

    Left to the size of a shuffle, tasks would be few: a tape has some thirty times the bytes of its order months.
    """
    months = stage(order_months(table(spark, sf_dir, "orders")), "order-months")
    months = months.repartition(spread_over(spark, months.count(), MONTHS_PER_TASK), "loan_id")
    history = nest_history(flat_tape(months), "loan_id", "month", unique=True)
    static = static_loans(spark, sf_dir, months)
    return static.withColumns({"msa_d": F.col("msa"), "servicer": F.lit("SV0")}).hint("shuffle_hash").join(history, "loan_id")


def spread_over(spark: SparkSession, rows: int, per_task: int) -> int:
    """Tasks of at most some ``per_task`` rows, one per core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_task))


def econ_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (zip, month): a customer is a zip, its nation the three-digit zip."""
    nat, zip_, acct = F.col("c_nationkey"), F.col("c_custkey"), F.col("c_acctbal")
    span = F.sequence(F.lit(ECON_FIRST).cast("date"), F.lit(ECON_LAST).cast("date"), F.expr("interval 1 month"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    # Dealt before the explode: afterwards there are 84 times as many rows.
    dealt = customers.repartition(spread_over(spark, customers.count(), ZIPS_PER_TASK), "c_custkey")
    base = dealt.select("*", F.explode(span).alias("month"))
    m = month_index("month") - (1995 * 12 + 1)
    cycle = (m % 24) / F.lit(12.0)
    return base.select(
        zip_.alias("zip"), F.lpad(nat.cast("string"), 3, "0").alias("zip3"), "month",
        (100.0 + nat + 0.4 * m).alias("zip3_hpi"),
        (3.0 + ((zip_ + m) % 50) / F.lit(10.0)).alias("unemp_rate"),
        (2000.0 + acct).alias("lbr_force"),
        (6.0 + cycle).alias("mort_fix30"), (5.5 + cycle).alias("mort_fix15"), (4.0 + cycle).alias("treas10"),
        *[(F.lit(float(v)) + 100 * nat).alias(f"q{q}")
          for q, v in ((10, 20000), (25, 30000), (50, 50000), (75, 80000), (90, 120000))],
        F.when(nat % 5 == 0, "").otherwise(F.concat(F.lit("MSA"), nat.cast("string"))).alias("msa_name"),
        F.concat(F.lit("S"), nat.cast("string")).alias("state"),
        F.when(nat == 3, 0).otherwise(120 + 30 * (nat % 4)).alias("fc_days"),
        F.when(nat % 2 == 0, "Judicial").otherwise("Non-Judicial").alias("fc_type"),
    )


def scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three class probabilities per order, from hashed logits; class 0 is biased on purpose."""
    status = F.col("o_orderstatus")

    def logit(j: int, cls: str, shift: float):
        noise = hash28("o_orderkey", seed=j) / F.lit(268435456.0)
        return F.exp(noise + F.when(status == cls, 0.25).otherwise(0.0) + F.lit(shift))

    orders = table(spark, sf_dir, "orders")
    z = orders.repartition(spark.sparkContext.defaultParallelism, F.xxhash64("o_orderkey")).withColumns(
        {"e0": logit(0, "F", 0.6), "e1": logit(1, "O", 0.0), "e2": logit(2, "P", 0.0)})
    total = F.col("e0") + F.col("e1") + F.col("e2")
    return z.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("slicer"),
        F.col("o_totalprice").alias("feature"), status.alias("level"),
        F.when(status == "F", 0).when(status == "O", 1).otherwise(2).alias("obs_class"),
        F.trunc("o_orderdate", "MM").alias("month"),
        F.array(F.col("e0") / total, F.col("e1") / total, F.col("e2") / total).alias("probs"),
        F.lit("Overall").alias("no_groups"),
    )


_staged: dict[tuple[str, str, str], DataFrame] = {}


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the derived tables, written once per session and read from then on."""
    makers = {"loans": nested_loans, "econ": econ_table, "scored": scored_table}
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _staged:
        # Small compressed files expand about 30 times in the explodes that follow: one file per core at least.
        _staged[key] = stage(makers[name](spark, sf_dir), name)
    return _staged[key]
