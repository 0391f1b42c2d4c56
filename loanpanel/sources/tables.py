"""Reading, nesting, staging and writing tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 500_000  # a joined side is broadcast only when it is counted and found below this
HOT_ROWS = 1_000_000  # rows of one key that a task of a shuffled join takes
_own_dirs: dict[str, str] = {}  # folder of each local session that names none


def shared_dir(spark: SparkSession) -> str:
    """The folder for staged tables: the one the cluster names.

    A machine-local folder is taken only by a local master, where driver and
    executors are the same machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if spark.sparkContext.applicationId not in _own_dirs:
        _own_dirs[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="loanpanel-")
    return _own_dirs[spark.sparkContext.applicationId]


def stage(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder, in a folder per value of ``by`` if given, and read it back.

    Cuts the lineage, fixes the rows for every later scan, survives the loss of
    executors and gives Catalyst real sizes for its join choices.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loanpanel/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*([by] if by else [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_loans(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Loan table, one row per loan with nested ``monthly`` history.

    ``fmt='jdbc'`` with the usual options reads it from a database instead.
    """
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def read_econ(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Economic table, one row per (geo, month)."""
    return read_loans(spark, path, fmt, **options)


def nest_history(tape: DataFrame, key: str = "loan_id", order: str = "month", unique: bool = False,
                 on_repeat: str = "error") -> DataFrame:
    """Flat monthly tape to one row per loan with ``monthly`` sorted by month.

    A loan has one row per month.  ``on_repeat`` says what happens to several rows of a
    (loan, month): ``"error"`` stops the job and names the loan, ``"largest"`` keeps the row that is largest
    column by column.  Either way they are first reduced with a map-side partial result, so a loan that
    fills a third of the tape with repeats reaches the final task as at most one
    row per calendar month.  ``unique=True`` skips that step, and its shuffle,
    for tapes known to be unique.

    The reduced rows are dealt to as many tasks as the tape has files, if those are more than the shuffle partitions: by the bytes of a
    shuffle, which are a tenth of those in memory, tasks would be few and hold millions of rows each.
    """
    _known_rule(on_repeat)
    rest = [c for c in tape.columns if c not in (key, order)]
    flat = tape
    if not unique:
        flat = tape.groupBy(key, order).agg(F.max(F.struct(*rest)).alias("_v"), F.count(F.lit(1)).alias("_n"))
        if on_repeat == "error":
            flat = flat.withColumn(order, F.when(F.col("_n") > 1, _repeated(F.col(key))).otherwise(F.col(order)))
        tasks = max(int(tape.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(tape.inputFiles()))
        flat = flat.select(key, order, "_v.*").repartition(tasks, key)
    history = F.sort_array(F.collect_list(F.struct(order, *rest)))  # array_sort calls a lambda per comparison
    return flat.groupBy(key).agg(history.alias("monthly"))


def _known_rule(on_repeat: str) -> None:
    if on_repeat not in ("error", "largest"):
        raise ValueError("on_repeat is 'error' or 'largest'")


def _repeated(loan: Column) -> Column:
    return F.raise_error(F.concat(F.lit("a month is repeated in the history of loan "), F.coalesce(
        loan.cast("string"), F.lit("NULL"))))


def ordered_history(loans: DataFrame, on_repeat: str = "error") -> DataFrame:
    """Loans with ``monthly`` sorted by month and one entry per month.

    For tables whose order is not known.  ``on_repeat`` as in ``nest_history``; ``"largest"`` keeps the
    entry that is largest field by field.
    """
    _known_rule(on_repeat)
    names = [f for f in loans.schema["monthly"].dataType.elementType.names if f != "month"]
    by_month = F.array_sort(F.transform("monthly", lambda m: F.struct(
        m["month"].alias("month"), F.struct(*[m[f].alias(f) for f in names]).alias("rest"))))

    def single(entries: Column) -> Column:
        # The last of the entries of a month is its largest one.
        last = F.filter(entries, lambda m, i: F.coalesce(
            F.get(entries, i + 1)["month"] != m["month"], F.lit(True)))
        if on_repeat == "error":
            last = F.when(F.size(last) < F.size(entries), _repeated(F.col("loan_id"))).otherwise(last)
        return last

    kept = F.transform(F.array(by_month), single)[0]
    fields = loans.schema["monthly"].dataType.elementType.names
    back = F.transform(kept, lambda m: F.struct(
        *[(m["month"] if f == "month" else m["rest"][f]).alias(f) for f in fields]))
    return loans.withColumn("monthly", back)


def checked_months(months: Column, loan: Column) -> Column:
    """The months of a history; the job stops at one that is out of order or has a month twice.

    Expressions that look a few entries ahead or back rely on that order.  Reads the months alone.
    """
    wrong = F.raise_error(F.concat(F.lit("sort the history with ordered_history first: loan "), F.coalesce(
        loan.cast("string"), F.lit("NULL")))).cast("array<date>")
    # A NULL month would be sorted to the front.
    fine = (F.sort_array(F.array_distinct(months)) == months) & (F.get(months, F.lit(0)).isNotNull() | (F.size(months) == 0))
    return F.when(months.isNull() | fine, months).otherwise(wrong)


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", limit: int = BROADCAST_ROWS,
               rows: int | None = None, sizes: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join a small keyed table to a big one, whatever the key skew.

    ``small`` holds one row per key and is cheap to count (a staged table); ``rows`` saves the count
    where it is known.  Below ``limit`` rows it is broadcast.  Above, both sides are shuffled on the keys.  A key
    with more than ``hot_rows`` rows of ``big`` is divided by a salt and its one row copied to each part; there
    are few of them, and other keys are not copied.  ``sizes`` (keys and ``n``) saves counting the keys of
    ``big``.  NULL keys match each other.
    """
    add = [c for c in small.columns if c not in on]
    right = small.select(*[F.col(c).alias(f"_k_{c}") for c in on], *add)
    keys = [big[c].eqNullSafe(right[f"_k_{c}"]) for c in on]
    if (small.count() if rows is None else rows) <= limit:
        return big.join(F.broadcast(right), keys, how).drop(*[f"_k_{c}" for c in on])
    counted = big.groupBy(*on).agg(F.count(F.lit(1)).alias("n")) if sizes is None else sizes
    hot = stage(counted.where(F.col("n") > hot_rows).select(
        *[F.col(c).alias(f"_h_{c}") for c in on], F.ceil(F.col("n") / hot_rows).cast("int").alias("_parts")), "hot-keys")
    if hot.isEmpty():
        return big.join(right, keys, how).drop(*[f"_k_{c}" for c in on])
    listed = F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot

    def parted(side: DataFrame, prefix: str) -> DataFrame:
        found = side.join(listed, [side[prefix + c].eqNullSafe(hot[f"_h_{c}"]) for c in on], "left")
        return found.withColumn("_parts", F.coalesce("_parts", F.lit(1))).drop(*[f"_h_{c}" for c in on])

    # The salt comes from the row's own values, so a retried task draws the same one.
    flat = [f"`{f.name}`" for f in big.schema.fields if isinstance(f.dataType, T.AtomicType)]
    left = parted(big, "").withColumn("_salt", F.pmod(F.xxhash64(*flat), F.col("_parts")).cast("int")).drop("_parts")
    right = parted(right, "_k_").withColumn("_salt_r", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    keys = [left[c].eqNullSafe(right[f"_k_{c}"]) for c in on]
    out = left.join(right, [*keys, left["_salt"] == right["_salt_r"]], how)
    return out.drop("_salt", "_salt_r", *[f"_k_{c}" for c in on])


def source_query(spark: SparkSession, source: DataFrame | str, needed: list[str] | None = None,
                 where: Column | str | None = None) -> DataFrame:
    """A user query as a source.

    Text may hold one ``%s`` where the needed column list goes.  A DataFrame is
    filtered first and then narrowed to the needed columns.
    """
    if isinstance(source, str):
        text = source.replace("%s", ", ".join(needed)) if needed else source.replace("%s", "*")
        df = spark.sql(text)
    else:
        df = source
    if where is not None:
        df = df.where(F.expr(where) if isinstance(where, str) else where)
    return df.select(*needed) if needed else df


def write_sorted(df: DataFrame, path: str, key: str | None = None, partitions: int | None = None) -> None:
    """Write a table, range-partitioned and sorted by ``key`` when one is given.

    Readers that filter on the key then skip row groups by their statistics.
    """
    if key:
        parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # A hash of the other columns takes part in the range, so rows of one hot key can be split.
        df = stage(df, "unsorted")  # the range bounds are sampled from it first: without this its plan runs twice
        others = [f.name for f in df.schema.fields
                  if f.name != key and f.dataType.typeName() not in ("map", "variant")]
        tie = [F.xxhash64(*others)] if others else []
        df = df.repartitionByRange(parts, key, *tie).sortWithinPartitions(key)
    df.write.mode("overwrite").parquet(path)
