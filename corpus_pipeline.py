"""From raw documents to training sequences: rules, near copies, personal data, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as
the next one's ``docs``.

Cases, alike for all stages: extra columns are kept, whatever their names, up to the last stage; an empty table stays empty; a row that
repeats is a document of its own.  What a stage does with NULL or empty texts, very long ones and ties is said at the stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanpanel.llm import mixing, packing, pii, quality_rules, simhash
from loanpanel.llm.common import written


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules.

    NULL and empty texts have no words and go.  Long texts are judged whole; a ratio on a limit passes.
    """
    return quality_rules.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    NULL and empty texts are copies of each other.  Rows that tie in id and text stay as one; a NULL id comes last.
    """
    return simhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind.

    NULL and empty texts stay as they are.  Spans that overlap become one cut with a mark for each that starts outside the others.
    """
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them.

    A NULL source is a source.  Texts without words take no part of a fraction.  Ties of keys share what is left of a cut.
    """
    return mixing.mix_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with a checksum of their tokens.

    A NULL or empty text is its end token alone; a long one is cut into as many pieces as sequences it reaches.
    """
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
                         "ids")


STAGES = [("quality rules", rules), ("near copies", near_copies), ("personal data", personal_data),
          ("mixture", mixture), ("sequences", sequences)]

ORACLE_SQL = None  # compression, hashes and tokens are beyond SQL; tests/llm has a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
