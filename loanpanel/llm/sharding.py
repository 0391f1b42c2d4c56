"""Sharding: jump consistent hashing of stable keys.

The shard follows from the key and the number of shards alone.  When one shard is
appended, a key either stays or moves into the new one.

Cases: NULL keys hash like one key of their own.  A NULL text has no bytes and the crc of no bytes.  Rows that
repeat a key share its shard, each with its own slot.  Long texts are measured whole.  An empty table gives no rows.  Extra columns are
not read by ``assign_shards`` and kept by ``write_shards``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanpanel.llm.common import map_texts, partition_bases, task_number, written
from loanpanel.sources.tables import join_small

SHARDS = 16
MULTIPLIER = np.uint64(2862933555777941757)  # of the published generator


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key; a key jumps about ln(shards) times."""
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    ahead = np.zeros(len(state), np.int64)
    while len(moving):
        at[moving] = ahead[moving]
        state[moving] = state[moving] * MULTIPLIER + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1
        ahead[moving] = ((at[moving] + 1) * (2.0**31 / draw)).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return at


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every document.

    Texts are read once and do not move.  Each task numbers its rows per shard;
    prefix sums over the tasks' counts then make the slots of a shard gapless, so no task ever holds a shard.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select("doc_id", (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                         F.xxhash64("doc_id").alias("key"))

    def begin():
        part, used = task_number(), np.zeros(shards, np.int64)

        def number(ids, sizes, crcs, keys):
            nonlocal used
            hashed = keys.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            shard, grown = jump_hash(hashed, shards), jump_hash(hashed, shards + 1)
            slot = np.zeros(len(shard), np.int64)
            order = np.argsort(shard, kind="stable")
            counts = np.bincount(shard, minlength=shards)
            starts = np.cumsum(counts) - counts
            slot[order] = np.arange(len(shard)) - starts[shard[order]] + used[shard[order]]
            used = used + counts
            return ids, sizes, crcs, pa.array(shard), pa.array(slot), pa.array(grown), pa.array(np.full(len(shard), part))
        return lambda columns: number(*columns)

    rows = written(map_texts(narrow, "doc_id long, size long, text_crc32 long, shard int, _slot long, grown_shard int, "
                                     "part int", begin), "shards")
    totals = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("total"))
    bases = written(partition_bases(totals, ["shard"]), "shard-bases")
    return join_small(rows, bases, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("base") + F.col("_slot")).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write whole documents, one folder per shard; a shard holds a file of every task that has rows for it."""
    @F.pandas_udf("int")
    def shard_of(keys):
        return pd.Series(jump_hash(keys.to_numpy().astype(np.int64).view(np.uint64), shards))

    docs.withColumn("shard", shard_of(F.xxhash64("doc_id"))).write.partitionBy("shard").parquet(path)
