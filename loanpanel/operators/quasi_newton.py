"""Full-batch fits: a limited-memory quasi-Newton method whose steps are Spark jobs.

A step tries a few lengths along its direction at once: one job sums value and gradient of all of them, and the cost of the validation rows
beside.  So every step knows both costs, and the fit can stop on either.  The driver holds some dozen
vectors of the size of the weights.
"""

from __future__ import annotations

import math
import sys
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanpanel.operators.network import Network
from loanpanel.operators.training import _form, batch_gradient, pack, unpack

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMORY = 10  # pairs of steps and gradient changes that stand for the curvature
LADDER = (1.0, 0.25, 4.0)  # lengths tried in one job
SHORTER, LADDERS = 64.0, 5  # when none does, all are divided by so much, at most so often
ENOUGH = 1e-4  # share of the decrease promised by the slope that a length must keep
HELD_LOSS, HELD_ROWS, LOSS, ROWS = -4, -3, -2, -1  # places beside the gradient


@dataclass
class Point:
    weights: np.ndarray
    value: float  # what is minimized: mean loss and penalty
    gradient: np.ndarray
    cost: float  # mean loss of the training rows
    held: float | None  # mean loss of the validation rows


def _add(points: list[np.ndarray], shapes, acts, is_cat: bool, n_cat: int):
    """Task body: loss, gradient and rows of each point, summed over the task."""
    def add(batches):
        totals = np.zeros((len(points), len(points[0]) + 4))
        for part in batches:
            if not part.num_rows:
                continue
            x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            y, held = (part.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            held = held.astype(bool)
            for total, flat in zip(totals, points):
                for rows, loss_at, rows_at in ((~held, LOSS, ROWS), (held, HELD_LOSS, HELD_ROWS)):
                    n = int(rows.sum())
                    if n:
                        loss, gradient = batch_gradient(flat, shapes, acts, x[rows], y[rows], is_cat, n_cat=n_cat)
                        total[loss_at] += loss
                        total[rows_at] += n
                        if loss_at == LOSS:
                            total[:-4] += gradient * n
        for k, total in enumerate(totals):
            if total[ROWS] + total[HELD_ROWS]:
                at = np.concatenate((np.arange(len(total) - 4), (HELD_LOSS, HELD_ROWS, LOSS, ROWS))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at), pa.array(total)],
                                                 names=["point", "at", "value"])
    return add


def evaluate(table: DataFrame, net: Network, kind: str, penalty: np.ndarray, points: list[np.ndarray]) -> list[Point]:
    """All points in one Spark job over ``x, y, held``."""
    shapes, acts = _form(net)
    body = _add(points, shapes, acts, kind == "cat", len(net.cat))
    sums = table.select("x", "y", "held").mapInArrow(body, "point int, at int, value double").groupBy("point", "at").agg(
        F.sum("value").alias("value")).toPandas()  # one row per point and weight
    out = []
    for k, flat in enumerate(points):
        found = sums[sums["point"] == k].set_index("at")["value"]
        if found.empty or not found[ROWS]:
            raise ValueError("no rows to fit on")
        cost = found[LOSS] / found[ROWS]
        gradient = found.loc[range(len(flat))].to_numpy() / found[ROWS] + penalty * flat
        value = float(cost + (penalty * flat * flat).sum() / 2)
        held = float(found[HELD_LOSS] / found[HELD_ROWS]) if found[HELD_ROWS] else None
        out.append(Point(flat, value, gradient, float(cost), held))
    return out


def _direction(gradient: np.ndarray, memory) -> np.ndarray:
    """Minus the gradient times the inverse curvature that ``memory`` stands for."""
    out, shares = -gradient, []
    for step, change in reversed(memory):
        share = (step @ out) / (step @ change)
        out = out - share * change
        shares.append(share)
    if memory:
        step, change = memory[-1]
        out = out * (step @ change) / (change @ change)
    for (step, change), share in zip(memory, reversed(shares)):
        out = out + step * (share - (change @ out) / (step @ change))
    return out


def minimize(evaluated: Callable[[list[np.ndarray]], list[Point]], start: np.ndarray, max_iter: int, tol: float,
             seen: Callable[[int, Point], bool]) -> Point:
    """The last point.  ``seen(step, point)`` is told every step, the start as step 0, and ends the fit by returning False.

    The fit also ends when no entry of the gradient is above ``tol``, or no tried length lowers the value any more.
    """
    now, memory = evaluated([start])[0], deque(maxlen=MEMORY)
    if not seen(0, now):
        return now
    for step in range(1, max_iter + 1):
        if np.abs(now.gradient).max(initial=0.0) <= tol:
            break
        found = None
        while found is None:
            along = _direction(now.gradient, memory)
            slope = float(along @ now.gradient)
            length = 1.0 if memory else 1.0 / max(1.0, float(np.linalg.norm(now.gradient)))
            if slope < 0:
                for _ in range(LADDERS):
                    tried = [length * rung for rung in LADDER]
                    points = evaluated([now.weights + t * along for t in tried])
                    good = [p for t, p in zip(tried, points)
                            if math.isfinite(p.value) and p.value < now.value and p.value <= now.value + ENOUGH * t * slope]
                    if good:
                        found = min(good, key=lambda p: p.value)
                        break
                    length /= SHORTER
            if found is None:
                if not memory:
                    return now
                memory.clear()  # once more along the gradient itself
        moved, change = found.weights - now.weights, found.gradient - now.gradient
        if moved @ change > 1e-12 * np.linalg.norm(moved) * np.linalg.norm(change):
            memory.append((moved, change))
        now = found
        if not seen(step, now):
            break
    return now


def fit(table: DataFrame, net: Network, kind: str, penalty: np.ndarray, max_iter: int, tol: float,
        patience: int | None = None) -> tuple[Network, list[tuple[int, float, float | None]]]:
    """Best network, and ``(step, cost, validation cost)`` of every step from the start on, over ``x, y, held`` rows.

    Costs are cross-entropy, or root mean square error.  With validation rows the best step is the one of lowest validation cost, and
    ``patience`` ends the fit so many steps after it.  ``penalty`` is the curvature of a quadratic penalty on each weight.
    """
    costs: list[tuple[int, float, float | None]] = []
    best: list = [math.inf, 0, None]

    def scaled(cost: float | None) -> float | None:
        return cost if cost is None or kind == "cat" else math.sqrt(cost)

    def seen(step: int, point: Point) -> bool:
        costs.append((step, scaled(point.cost), scaled(point.held)))
        score = point.value if point.held is None else point.held
        if score < best[0]:
            best[:] = [score, step, point.weights]
        return patience is None or step - best[1] < patience

    minimize(lambda points: evaluate(table, net, kind, penalty, points), pack(net), max_iter, tol, seen)
    return unpack(best[2], net), costs
