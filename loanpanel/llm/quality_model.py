"""Quality classifier: logistic regression over hashed word n-grams, fitted by follow the regularised leader.

Tokens are runs of letters and digits, or runs of other visible characters; the features are hashed single
tokens and pairs of neighbours.  The fit takes about ``TRAIN_ROWS`` labelled texts, drawn by a hash of the id, in
``BATCHES`` batches for ``EPOCHS`` rounds.  For each batch Spark sums the gradient per feature, in fixed point, so that
the sums and the model do not depend on partitions or their order; the driver holds one number
per hashed feature and makes the proximal update.  A text is scored with one sparse dot product.

Cases: NULL and empty texts score by the intercept alone.  A doc_id with several labels counts as the label of the
majority, ties as 1.  NULL ids are never learned from and count as not held out.  Without labels every score is 0.5.
Repeated rows score alike.  Texts are scored whole, whatever their length.  An empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanpanel.llm.common import map_texts, written

BITS = 18  # 2 ** BITS hashed features
TRAIN_ROWS = 6000
BATCHES, EPOCHS = 6, 4
ALPHA, BETA, L1, L2 = 1.0, 0.5, 0.5, 1.0
POINT = 2.0**32  # gradients are summed as whole multiples of 1 / POINT
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\x00-\x20 0-9A-Za-z\x80-\xff]+")


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Hashed features of the whole text, repeats included."""
    digest = xxhash.xxh64_intdigest
    words = TOKEN.findall((text or "").encode("utf-8", "replace"))
    one = np.fromiter((digest(w, 7) for w in words), np.uint64, len(words))
    mixed = one * np.uint64(0x9E3779B97F4A7C15)
    two = (mixed[:-1] ^ (one[1:] >> np.uint64(7)) + one[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (np.concatenate((one, two)) >> np.uint64(64 - bits)).astype(np.int32)


def margin(found: np.ndarray, weights: np.ndarray) -> float:
    """Intercept, plus the weights of the features over the root of their number."""
    if not len(found):
        return float(weights[-1])
    return float(weights[-1] + weights[found].sum() / np.sqrt(len(found)))


def chance(x: np.ndarray | float):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = TRAIN_ROWS) -> DataFrame:
    """``label, batch, found``: features of about ``rows`` labelled texts, written by batch."""
    marks = labels.where(usable & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("int").alias("label"))
    total = marks.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality sample")), F.lit(1_000_000_007)) / 1_000_000_007.0
    drawn = marks.where(draw < min(1.0, rows / max(total, 1)))
    # About ``rows`` ids of 12 bytes: the bound makes the broadcast safe.
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    batch = F.pmod(F.xxhash64("doc_id", F.lit("batch")), F.lit(BATCHES)).cast("int")

    def begin():
        def hashed(marks, batches, texts):
            found = [features(t.as_py()) for t in texts]
            return marks, batches, pa.array(found, pa.list_(pa.int32()))
        return lambda columns: hashed(*columns)

    return written(map_texts(texts.select("label", batch.alias("batch"), "text"),
                             "label int, batch int, found array<int>", begin).repartition("batch"), "quality-sample")


def gradient(batch: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the batch and the gradient of the log loss at each; one Spark job."""
    shared = batch.sparkSession.sparkContext.broadcast(weights)

    def begin():
        def sums(marks, found):
            current, total = shared.value, np.zeros(len(shared.value))
            for label, row in zip(marks.to_pylist(), found):
                at = row.values.to_numpy()
                error = chance(margin(at, current)) - label
                total[-1] += error
                if len(at):
                    np.add.at(total, at, error / np.sqrt(len(at)))
            hit = np.flatnonzero(total)
            return pa.array(hit), pa.array(np.round(total[hit] * POINT).astype(np.int64))
        return lambda columns: sums(*columns)

    summed = map_texts(batch.select("label", "found"), "at long, g long", begin).groupBy("at").agg(F.sum("g").alias("g"))
    rows = summed.toArrow()
    shared.destroy()
    at, g = rows["at"].to_numpy(), rows["g"].to_numpy()
    order = np.argsort(at)
    return at[order], g[order] / POINT


def fit(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights by follow the regularised leader; the last one is the intercept."""
    sample = labelled_sample(docs, labels, usable, rows)
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    weights = np.zeros((1 << BITS) + 1)
    for _ in range(EPOCHS):
        for k in range(BATCHES):
            at, g = gradient(sample.where(F.col("batch") == k), weights)
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * weights[at]
            n[at] += g * g
            free = at == len(weights) - 1  # the intercept is not shrunk to zero
            shrunk = np.where(free, z[at], np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0))
            weights[at] = -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
    return weights


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, score`` of every whole text; one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def begin():
        def rate(ids, texts):
            return ids, [float(chance(margin(features(t.as_py()), shared.value))) for t in texts]
        return lambda columns: rate(*columns)

    return map_texts(docs.select("doc_id", "text"), "doc_id long, score double", begin)
