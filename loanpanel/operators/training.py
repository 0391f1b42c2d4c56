"""Fitting networks with rectified layers, embeddings, weight decay or a linear output.

Rows are dealt to batches by a hash of their source values.  One step is one Spark job over one batch: tasks sum
the gradient of their rows, Spark adds the sums by weight, and the driver moves the one weight
vector it holds.  The steps, and so the fit, are the same for any number of partitions or tasks.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanpanel.operators.network import LEAK, Network, _activate, first_inputs, first_sums
from loanpanel.sources.tables import stage

# Executors get these functions themselves: they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS, LOSS = -1, -2  # positions of the row count and the summed loss beside the weights
PIECE = 100_000  # rows of a batch that one task writes


def start_network(cts: list[str], cat: list[str], emb: dict[str, int], levels: dict[str, int],
                  layers: list[tuple[int, str]], seed: int) -> Network:
    """Random starting weights: scaled by the width of each layer, biases zero."""
    rng = np.random.default_rng(seed)
    tables = [rng.normal(0, 0.1, (levels[f], dim)).tolist() for f, dim in emb.items()]
    width = len(cts) + sum(levels[c] for c in cat) + sum(emb.values())
    made = []
    for size, act in layers:
        made.append((rng.normal(0, math.sqrt(2 / (width + size)), (width, size)).tolist(), [0.0] * size, act))
        width = size
    return Network(cts, cat, made, list(emb), tables)


def pack(net: Network) -> np.ndarray:
    parts = [np.asarray(p, dtype=float).ravel() for w, b, _ in net.layers for p in (w, b)]
    return np.concatenate(parts + [np.asarray(t, dtype=float).ravel() for t in net.tables])


def _unpack(flat: np.ndarray, shapes, acts):
    """Views of the vector as (layers, tables)."""
    views, at = [], 0
    for shape in shapes:
        size = math.prod(shape)
        views.append(flat[at:at + size].reshape(shape))
        at += size
    n = 2 * len(acts)
    return [(views[2 * i], views[2 * i + 1], a) for i, a in enumerate(acts)], views[n:]


def unpack(flat: np.ndarray, like: Network) -> Network:
    layers, tables = _unpack(flat, *_form(like))
    return Network(like.cts, like.cat, [(w.tolist(), b.tolist(), a) for w, b, a in layers], like.emb,
                   [t.tolist() for t in tables])


def _form(net: Network):
    shapes = [s for w, b, _ in net.layers for s in ((len(w), len(b)), (len(b),))]
    shapes += [(len(t), len(t[0])) for t in net.tables]
    return shapes, [a for _, _, a in net.layers]


def _slope(out: np.ndarray, act: str) -> np.ndarray:
    if act == "relu":
        return (out > 0).astype(float)
    if act == "leaky_relu":
        return np.where(out > 0, 1.0, LEAK)
    if act == "sigmoid":
        return out * (1.0 - out)
    return np.ones_like(out)


def batch_gradient(flat, shapes, acts, x, y, is_cat, copies=None, n_cat=0) -> tuple[float, np.ndarray]:
    """Summed loss of the rows, each counted ``copies`` times, and the gradient of their mean loss."""
    layers, tables = _unpack(flat, shapes, acts)
    n = len(x)
    copies = np.ones(n) if copies is None else copies
    share = copies / copies.sum()
    values, rows, index, embedded = first_inputs(x, tables, n_cat)
    (w, b, act), *rest = layers
    outs = [None, _activate(first_sums(w, b, values, rows, embedded), act)]
    for w, b, act in rest:
        outs.append(_activate(outs[-1] @ w + b, act))
    if is_cat:
        picked = outs[-1][np.arange(n), y.astype(int)]
        loss = float(copies @ -np.log(np.maximum(picked, 1e-300)))
        delta = outs[-1].copy()
        delta[np.arange(n), y.astype(int)] -= 1.0
        delta *= share[:, None]
    else:
        miss = outs[-1][:, 0] - y
        loss = float(copies @ (miss * miss))
        delta = (2.0 * share * miss)[:, None]
    grad = np.zeros_like(flat)
    g_layers, g_tables = _unpack(grad, shapes, acts)
    for i in range(len(layers) - 1, 0, -1):
        if i < len(layers) - 1:
            delta = delta * _slope(outs[i + 1], layers[i][2])
        g_layers[i][0][:] = outs[i].T @ delta
        g_layers[i][1][:] = delta.sum(axis=0)
        delta = delta @ layers[i][0].T
    if len(layers) > 1:
        delta = delta * _slope(outs[1], layers[0][2])
    first, w = g_layers[0][0], layers[0][0]
    first[:values.shape[1]] = values.T @ delta
    for j in range(rows.shape[1]):
        np.add.at(first, rows[:, j], delta)
    g_layers[0][1][:] = delta.sum(axis=0)
    if tables:
        first[len(w) - embedded.shape[1]:] = embedded.T @ delta
        back, at = delta @ w[len(w) - embedded.shape[1]:].T, 0
        for j, t in enumerate(tables):
            np.add.at(g_tables[j], index[:, j], back[:, at:at + t.shape[1]])
            at += t.shape[1]
    return loss, grad


def in_batches(table: DataFrame, batch: int) -> tuple[DataFrame, int]:
    """``x, y, copies, batch`` in a folder per batch, and the number of batches, each of about ``batch`` rows.

    The batch follows from ``key``, as ``x`` may differ in its last bits from run to run.
    Equal rows are counted once and their copies are dealt evenly over the batches, so rows that repeat
    cannot fill one.
    """
    alike = stage(table.groupBy("x", "y", "key").agg(F.count(F.lit(1)).alias("n")), "alike")
    total = alike.agg(F.sum("n")).first()[0] or 0
    n_batches = max(1, math.ceil(total / batch))
    own = F.pmod(F.col("key"), F.lit(n_batches))
    turn = F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("n"), F.lit(n_batches)) - 1)).alias("turn")
    dealt = alike.select("x", "y", "key", "n", turn).select(
        "x", "y", "key", (F.floor(F.col("n") / n_batches) + (F.col("turn") < F.col("n") % n_batches).cast("long")).alias("copies"),
        F.pmod(own + F.col("turn"), F.lit(n_batches)).cast("int").alias("batch"))
    pieces = math.ceil(total / n_batches / PIECE) or 1
    dealt = dealt.repartition("batch", F.pmod(F.xxhash64("key", F.lit("piece")), F.lit(pieces)))
    return stage(dealt.drop("key"), "batches", by="batch"), n_batches


def _sums(flat, shapes, acts, is_cat, n_cat):
    """Task body: gradient, loss and number of the task's rows, summed."""
    def add(batches):
        grad, rows, loss = np.zeros_like(flat), 0.0, 0.0
        for part in batches:
            if not part.num_rows:
                continue
            x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            y, copies = (part.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            err, g = batch_gradient(flat, shapes, acts, x, y, is_cat, copies.astype(float), n_cat)
            grad, rows, loss = grad + g * copies.sum(), rows + copies.sum(), loss + err
        if rows:
            at = np.concatenate([np.arange(len(flat)), [ROWS, LOSS]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(np.concatenate([grad, [rows, loss]]))], names=["at", "value"])
    return add


def train(table: DataFrame, net: Network, kind: str, epochs: int, batch: int, rates: tuple[float, float], l2: float,
          check_cost, patience: int | None) -> tuple[Network, list[tuple[int, float, float | None]]]:
    """Best network and the cost of every epoch on (x, y, key) rows.

    A step moves the weights by the gradient of one batch, scaled by running first and second moments.  An epoch is as
    many Spark jobs as there are batches.
    The learning rate runs from the first to the second of ``rates``.  With
    ``check_cost`` the best epoch is the one of lowest validation cost, and the
    fit ends ``patience`` epochs after it.
    """
    shapes, acts = _form(net)
    dealt, n_batches = in_batches(table, batch)
    flat, best, best_cost, best_at, costs = pack(net), net, math.inf, 0, []
    m, v, t = np.zeros_like(flat), np.zeros_like(flat), 0
    for e in range(1, epochs + 1):
        rate = rates[0] + (rates[1] - rates[0]) * (e - 1) / max(epochs - 1, 1)
        rows = loss = 0.0
        for b in range(n_batches):
            body = _sums(flat, shapes, acts, kind == "cat", len(net.cat))
            sums = dealt.where(F.col("batch") == b).select("x", "y", "copies").mapInArrow(
                body, "at int, value double").groupBy("at").agg(
                F.sum("value").alias("value")).toPandas().set_index("at")["value"]  # one row per weight
            if sums.empty:
                continue
            g = sums.loc[range(len(flat))].to_numpy() / sums[ROWS] + 2.0 * l2 * flat
            t, rows, loss = t + 1, rows + sums[ROWS], loss + sums[LOSS]
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            flat = flat - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        if not rows:
            raise ValueError("no rows to fit on")
        loss /= rows
        now = unpack(flat, net)
        held = check_cost(now) if check_cost else None
        costs.append((e, float(loss if kind == "cat" else math.sqrt(loss)), held))
        score = costs[-1][1] if held is None else held
        if score < best_cost:
            best, best_cost, best_at = now, score, e
        elif patience and e - best_at >= patience:
            break
    return best, costs
