"""Packing: concatenate all documents and cut the result into windows.

Every task tokenizes its documents once and notes the tokens before each of them in its own
partition.  Prefix sums over the partitions' totals give each document its place in the one
long sequence of all tokens; windows of ``LENGTH`` are then plain arithmetic.  A
document that crosses a window's end is cut into several pieces, its boundary records.
Only the very last window can be short, and it is the only one that is padded.

Cases: a NULL or empty text is the end token alone.  Repeated rows are packed each on their own.  A NULL doc_id stays NULL.
An empty table gives no pieces.  A long text is tokenized whole, white-space runs of any length included, and its pieces are cut from one
buffer.  Extra columns are not read.
"""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanpanel.llm.common import bound_batches, map_texts, partition_bases, task_number, written
from loanpanel.sources.tables import join_small

LENGTH = 1024
END = 0  # the id after each document
WIDTH = 4  # bytes of an id: unsigned, little-endian
# How the byte-level vocabulary splits a text before merging (fixed value of the public tokenizer).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A long run of what \s is there; tiktoken gives up on a run of about a million.
LONG_RUN = r"(?<![{0}])[{0}]{{10000,}}".format(r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000")


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte, by letter."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def load_encoder(path: str) -> tiktoken.Encoding:
    """The byte-level tokenizer file at ``path``, run by the faster of the two public libraries.

    Its vocabulary numbers the merges in order, so ranks and ids are the same, and
    both libraries give equal ids (tested over whole tables).  A text is cut at the file's added tokens, which give their own id.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {token["content"]: token["id"] for token in model.get("added_tokens", [])}
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in word): rank for word, rank in model["model"]["vocab"].items()
             if word not in special}
    return tiktoken.Encoding("packing", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


def encoded(encoder: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of a text.

    Where white space makes ``SPLIT`` fail, its long runs are cut out as the pattern would: without their last
    character when a word follows, and no token reaches over their start.
    """
    try:
        return encoder.encode_to_numpy(text, allowed_special="all")
    except ValueError:
        out, at = [], 0
        for run in re.finditer(LONG_RUN, text):
            last = run.end() == len(text) or any(text.startswith(s, run.end()) for s in encoder.special_tokens_set)
            end = run.end() if last else run.end() - 1
            out.append(encoder.encode_to_numpy(text[at:run.start()], allowed_special="all"))
            out.append(np.array(encoder._encode_single_piece(text[run.start():end]), np.uint32))
            at = end
        if not out:
            raise
        return np.concatenate([*out, encoder.encode_to_numpy(text[at:], allowed_special="all")])


def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, part, before, n, ids``: written once, so later steps see the same partitions."""
    def begin():
        encoder, part, before = load_encoder(tokenizer), task_number(), 0

        def encode(ids, texts):
            nonlocal before
            rows = []
            for doc, text in zip(ids, texts):
                found = encoded(encoder, text.as_py() or "")
                found = np.append(found, np.uint32(END)).astype("<u4")
                rows.append((doc.as_py(), part, before, len(found), found.tobytes()))
                before += len(found)
            return list(zip(*rows)) if rows else [[]] * 5
        return lambda columns: encode(*columns)

    bound_batches(docs.sparkSession)
    return written(map_texts(docs.select("doc_id", "text"), "doc_id long, part int, before long, n long, ids binary",
                             begin), "tokens")


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are the piece's tokens.  Texts are read once; no token is shuffled.
    """
    tokens = tokenized(docs, tokenizer)
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    bases = written(partition_bases(totals, []), "token-bases")
    placed = join_small(tokens, bases, ["part"]).withColumn("_at", F.col("base") + F.col("before"))
    windows = F.sequence(F.floor(F.col("_at") / length), F.floor((F.col("_at") + F.col("n") - 1) / length))
    cut = placed.select("doc_id", "n", "ids", "_at", F.explode(windows).alias("sequence_id"))
    start = F.greatest(F.col("sequence_id") * length - F.col("_at"), F.lit(0))
    stop = F.least((F.col("sequence_id") + 1) * length - F.col("_at"), F.col("n"))
    cut = cut.select("*", start.alias("start"), (stop - start).alias("length"))
    return cut.select(
        "doc_id", "start", "length",
        F.substring("ids", (F.col("start") * WIDTH + 1).cast("int"), (F.col("length") * WIDTH).cast("int")).alias("ids"),
        F.col("n").alias("doc_tokens"), "sequence_id",
        (F.col("_at") + F.col("start") - F.col("sequence_id") * length).alias("offset"))
