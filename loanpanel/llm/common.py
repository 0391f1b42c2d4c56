"""What several of the text operators need."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanpanel.sources.tables import stage

BATCH_BYTES = 8 << 20  # of texts that a Python worker is given at once, besides the one that is longer
BLOCK = 1024  # partitions whose totals are summed together in the first level of prefix sums


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of the id as text; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def bound_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by bytes and not by rows alone, unless the session has a lower limit."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?[0-9]+)\s*([kmgt]?)b?", spark.conf.get(key).strip().lower()).groups()
    now = int(number) << 10 * ("kmgt".index(unit) + 1 if unit else 0)
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def map_texts(df: DataFrame, schema: str, begin: Callable[[], Callable]) -> DataFrame:
    """Apply a Python function to the rows of each Arrow batch.

    ``begin()`` runs once a task and returns ``fn(columns) -> columns``, where
    columns are Arrow arrays in, and lists or arrays out, in the order of
    ``schema``.  Each output row belongs to an input row or to the whole batch.
    """
    fields = df.sparkSession.createDataFrame([], schema).schema
    names = fields.names
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = begin()
        for batch in batches:
            out = fn(batch.columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=arrow.field(n).type) if not isinstance(c, pa.Array) else c.cast(arrow.field(n).type)
                 for n, c in zip(names, out)], schema=arrow)

    return df.mapInArrow(run, schema)


def task_number() -> int:
    """Number of the running task's partition."""
    context = TaskContext.get()
    return context.partitionId() if context else 0


def partition_bases(totals: DataFrame, groups: list[str]) -> DataFrame:
    """Exclusive prefix sums ``base`` of ``total`` over ``part``, per group.

    ``totals`` has one row per (group, partition) of a written table, so it grows with the
    number of tasks and not with the rows.  Totals are summed in blocks of partitions and
    then over the blocks: no window holds more than ``BLOCK`` rows of a group, or
    one row for every ``BLOCK`` partitions.
    """
    totals = totals.withColumn("_block", F.floor(F.col("part") / BLOCK))
    blocks = totals.groupBy(*groups, "_block").agg(F.sum("total").alias("_sum"))
    over = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("_block")
    blocks = blocks.select(*groups, "_block", F.coalesce(F.sum("_sum").over(
        over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_outer"))
    inner = Window.partitionBy(*groups, "_block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    out = totals.withColumn("_inner", F.coalesce(F.sum("total").over(inner), F.lit(0)))
    out = out.join(blocks, [*groups, "_block"])
    return out.select(*groups, "part", (F.col("_inner") + F.col("_outer")).alias("base"))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back."""
    return stage(df, f"llm-{label}")
