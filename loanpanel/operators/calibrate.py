"""Bias correction: shift output log odds so that mean probabilities hit class rates."""

from __future__ import annotations

import logging

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanpanel.functions.expr import sum_of

log = logging.getLogger(__name__)


def class_log_odds(probs: str, classes: int) -> list[Column]:
    """ln(p_j / p_last) for every class but the last."""
    p = F.col(probs)
    return [F.log(p[j] / p[classes - 1]) for j in range(classes - 1)]


def bias_start(df: DataFrame, classes: int, probs: str = "probs", obs: str = "obs_class") -> DataFrame:
    """One row per adjustable class: observed rate, mean log odds, starting shift."""
    odds = class_log_odds(probs, classes)
    p = F.col(probs)
    inside = sum_of([F.when((p[j] > 0) & (p[j] < 1), 0).otherwise(1) for j in range(classes)]) == 0
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(~inside, 1)).alias("bad"),
        *[F.avg(F.when(F.col(obs) == j, 1.0).otherwise(0.0)).alias(f"r{j}") for j in range(classes)],
        *[F.avg(F.when(inside, o)).alias(f"l{j}") for j, o in enumerate(odds)],
    )
    each = F.explode(F.array(*[F.struct(
        F.lit(j).alias("class"), F.col(f"r{j}").alias("rate"), F.col(f"r{classes - 1}").alias("last_rate"),
        F.col(f"l{j}").alias("mean_log_odds")) for j in range(classes - 1)])).alias("s")
    out = row.select("n", "bad", each).select("n", "bad", "s.*")
    start = F.log(F.col("rate") / F.nullif("last_rate", F.lit(0.0))) - F.col("mean_log_odds")
    return out.withColumn("start", start)


def fit_bias(df: DataFrame, classes: int, probs: str = "probs", obs: str = "obs_class", iters: int = 10,
             tol: float = 1e-12) -> tuple[list[float], list[float]]:
    """Shifts b of the first m-1 classes, and the squared error after each step.

    Minimises sum_k (mean p*_k - rate_k)^2 with p* = softmax(log odds + b), by
    Gauss-Newton.  A step is one aggregate over the rows, which returns the mean
    probabilities and their mean products; nothing else reaches the driver.
    """
    if classes < 2:
        raise ValueError("bias correction needs a categorical model")
    first = bias_start(df, classes, probs, obs).collect()
    if first[0]["bad"]:
        raise ValueError(f"{first[0]['bad']} rows hold a probability of 0 or 1")
    if any(r["start"] is None for r in first):
        raise ValueError("a class has no rows in the bias data")
    rates = np.array([r["rate"] for r in first] + [first[0]["last_rate"]])
    b = np.array([r["start"] for r in first])
    m = classes - 1
    odds = df.select(*[o.alias(f"l{j}") for j, o in enumerate(class_log_odds(probs, classes))]).persist()

    def moments(shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # exp of the largest exponent is taken out, so no term can overflow.
        moved = [F.col(f"l{j}") + F.lit(float(shift[j])) for j in range(m)]
        top = F.greatest(F.lit(0.0), *moved)
        e = odds.select(top.alias("top"), *[x.alias(f"x{j}") for j, x in enumerate(moved)])
        e = e.select(F.exp(-F.col("top")).alias("e_last"), *[F.exp(F.col(f"x{j}") - F.col("top")).alias(f"e{j}")
                                                             for j in range(m)])
        total = sum_of([F.col(f"e{j}") for j in range(m)]) + F.col("e_last")
        p = e.withColumn("t", total).select(*[(F.col(f"e{j}") / F.col("t")).alias(f"p{j}") for j in range(m)],
                                            (F.col("e_last") / F.col("t")).alias(f"p{m}"))
        pairs = [(j, k) for j in range(m) for k in range(j, m)]
        row = p.agg(*[F.avg(f"p{j}") for j in range(classes)],
                    *[F.avg(F.col(f"p{j}") * F.col(f"p{k}")) for j, k in pairs]).first()
        mean = np.array(row[:classes])
        cross = np.zeros((m, m))
        for (j, k), v in zip(pairs, row[classes:]):
            cross[j, k] = cross[k, j] = v
        return mean, cross

    try:
        mean, cross = moments(b)
        history = [float(((mean - rates) ** 2).sum())]
        for _ in range(iters):
            if history[-1] < tol:
                break
            # d mean_k / d b_j = [k = j] mean_j - mean(p_j p_k); the last class follows from the others.
            top = np.diag(mean[:m]) - cross
            jac = np.vstack([top, -top.sum(axis=0)])
            step = np.linalg.lstsq(jac, rates - mean, rcond=None)[0]
            scale = 1.0
            while scale > 1e-4:
                trial_mean, trial_cross = moments(b + scale * step)
                sse = float(((trial_mean - rates) ** 2).sum())
                if sse < history[-1]:
                    break
                scale /= 2
            else:
                log.warning("bias correction stopped: check that the error %.3g is reasonable", history[-1])
                break
            b, mean, cross = b + scale * step, trial_mean, trial_cross
            history.append(sse)
        log.info("bias shifts %s, error %.3g", b, history[-1])
    finally:
        odds.unpersist()
    return [float(x) for x in b], history


def apply_bias(df: DataFrame, shift: list[float], probs: str = "probs") -> DataFrame:
    """Probabilities after the shift, without touching the network."""
    m = len(shift)
    moved = [F.col(probs)[j] * F.lit(float(np.exp(s))) for j, s in enumerate(shift)] + [F.col(probs)[m]]
    out = df.withColumn("_e", F.array(*moved))
    total = sum_of([F.col("_e")[j] for j in range(m + 1)])
    return out.withColumn("_t", total).withColumn(
        probs, F.array(*[F.col("_e")[j] / F.col("_t") for j in range(m + 1)])).drop("_e", "_t")
