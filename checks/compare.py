"""Run queries against their SQL: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import oracle
from loanpanel.plans.queries import all_queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def spark_session(cores: int = 8) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("loanpanel")
             .config("spark.sql.shuffle.partitions", str(cores)).config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "16g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].dt.strftime("%Y-%m-%d")
        elif df[c].dtype == object:
            df[c] = df[c].map(lambda v: v if v is None else str(v))
    return df.sort_values(list(df.columns), ignore_index=True)


def differences(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str | None:
    """None when equal, else a short description of the first difference."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(sql_df.columns)}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} != {len(sql_df)}"
    a, b = _plain(spark_df), _plain(sql_df)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = int((~same).idxmax())
            return f"{c}: {int((~same).sum())} differ, first {a[c][i]!r} != {b[c][i]!r}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark, con, bad = spark_session(), duck(sf_dir), 0
    texts = oracle()
    for name, fn in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = fn(spark, sf_dir).toPandas()
            took = time.time() - start
            if name in texts:
                diff = differences(got, con.execute(texts[name]).df())
                bad += diff is not None
                print(f"{'ok  ' if diff is None else 'FAIL'} {name} {len(got)} rows {took:.1f}s {diff or ''}", flush=True)
            else:
                print(f"rows {name} {len(got)} rows {took:.1f}s", flush=True)
        except Exception as e:  # noqa: BLE001 - a report over all queries
            bad += 1
            print(f"FAIL {name} {type(e).__name__} {str(e)[:600]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
