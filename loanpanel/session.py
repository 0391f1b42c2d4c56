"""Session settings the operators are measured with."""

from __future__ import annotations

from pyspark.sql import SparkSession


LIMIT, PAIRS_LIMIT = 4000, 8000  # bytes of a method


def tune(spark: SparkSession, limit: int = LIMIT) -> SparkSession:
    """Runtime SQL settings for wide rows.

    Rows of a hundred derived columns make Spark fuse a stage into one very
    large method.  The JVM never compiles methods above 8,000 bytes, and runs
    those near that size interpreted for a long time before it does.  Above this
    limit Spark falls back to one compiled projection per operator.  Measured on
    the 24-month window at sf0.1: 10 seconds at a limit of 8,000, 2 at 4,000.

    Two explodes in a row, as-of months and target months, make methods between the two sizes, and without a fused stage every pair
    copies the history: pairs over 6 times sf0.1 took 31 seconds at 4,000 and 12 at 8,000 (``PAIRS_LIMIT``).
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(limit))
    return spark
