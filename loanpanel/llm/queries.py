"""One query per operator of the training-data pipeline, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from loanpanel.llm import (
    bpe,
    language_id,
    mixing,
    packing,
    pii,
    quality_model,
    quality_rules,
    sharding,
    simhash,
    spelling,
    topk,
    url_filter,
    whitening,
)
from loanpanel.llm.common import crc_of_id
from loanpanel.llm.oracle import TOP_SQL, URL_SQL

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    _queries[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _is(kind: int):
    return lambda span: span["kind"] == kind


@query
def op1_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op2_personal_data(spark, sf_dir):
    found = pii.find_personal(table(spark, sf_dir, "documents"))
    counts = [F.array_size(F.filter("base", _is(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        pii.as_text(F.col("spans")).alias("spans"))


@query
def op3_url_filter(spark, sf_dir):
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


@query
def op4_exact_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op5_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_of_id() % 5 == 0, F.lit(False))
    weights = quality_model.fit(docs, table(spark, sf_dir, "labels"), crc_of_id() % 5 != 0)
    return quality_model.score(docs, weights).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op7_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op8_sharding(spark, sf_dir):
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


@query
def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_of_id() % 4 == 2, F.lit(False))
    trees = language_id.train(docs, crc_of_id() % 4 != 2)
    return language_id.identify(docs, trees).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op10_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


@query
def op11_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_spelling_variants(spark, sf_dir):
    return spelling.group_variants(table(spark, sf_dir, "documents"))


@query
def op13_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select("doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


def corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def corpus_oracle() -> dict[str, str]:
    return {"op3_url_filter": URL_SQL, "op4_exact_top_k": TOP_SQL} | (
        {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
