"""Fits; every one ends as a ``Network`` that scores anywhere.

``fit_model`` fits softmax, sigmoid-network and linear models, ``fit_network`` any layers and embeddings.  Both take full-batch quasi-Newton
steps, one Spark job each; ``fit_network`` takes a step per batch instead when a batch size is given.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanpanel.operators.features import FeatureDefs, apply_features, design, fit_features
from loanpanel.operators.network import InputModel, Network, load_inputs, network_output, save_inputs
from loanpanel.operators.quasi_newton import fit as fit_steps
from loanpanel.operators.training import pack, start_network
from loanpanel.operators.training import train as fit_epochs
from loanpanel.sources.tables import stage

TOLERANCE = 1e-8  # a fit ends when no entry of the gradient is above

COSTS = "step int, train_cost double, valid_cost double"


@dataclass
class Fitted:
    """Network, feature definitions, the cost table (step, train, valid) and the models that feed it."""

    net: Network
    defs: FeatureDefs
    costs: list[tuple[int, float, float | None]] = field(default_factory=list)
    inputs: list[InputModel] = field(default_factory=list)

    @property
    def best_step(self) -> int:
        held_out = [c for c in self.costs if c[2] is not None]
        return min(held_out, key=lambda c: c[2])[0] if held_out else min(self.costs, key=lambda c: c[1])[0]

    def cost_table(self, spark: SparkSession) -> DataFrame:
        table = spark.createDataFrame(self.costs, COSTS)
        return table.withColumn("best", F.col("step") == self.best_step)

    def save(self, spark: SparkSession, path: str) -> None:
        self.net.save(spark, f"{path}/network")
        self.defs.save(f"{path}/features")
        spark.createDataFrame(self.costs, COSTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/costs")
        save_inputs(spark, self.inputs, path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Fitted":
        costs = [tuple(r) for r in spark.read.parquet(f"{path}/costs").orderBy("step").collect()]
        return Fitted(Network.load(spark, f"{path}/network"), FeatureDefs.load(spark, f"{path}/features"), costs,
                      load_inputs(spark, path))


def design_table(df: DataFrame, defs: FeatureDefs, cts: list[str], cat: list[str], target: str, kind: str,
                 emb: list[str] = ()) -> DataFrame:
    """Staged (x array<double>, y double, key long): the only columns a fit scans.

    ``key`` is a hash of the values before they are normalized, the same in every run.

    Rows without a target are left out.  A class that the definitions do not know is an error: it has no
    output to be compared with.
    """
    is_cat, df = kind == "cat", df.where(F.col(target).isNotNull())
    df = df.withColumn("_key", F.xxhash64(*cts, *cat, *emb, target))
    ready = apply_features(df, defs, cts if is_cat else [*cts, target], [*cat, *emb, *([target] if is_cat else [])],
                           target if is_cat else None)
    ready = design(ready, defs, cts, cat, emb, "x")
    label = F.col(f"i_{target}") if is_cat else F.col(f"z_{target}")
    out = stage(ready.select("x", label.cast("double").alias("y"), F.col("_key").alias("key")), "design")
    if is_cat and (unknown := out.where("y is null").count()):
        raise ValueError(f"{unknown} rows have a {target} that is not among the {defs.n_levels[target]} known classes")
    return out


def cost(table: DataFrame, net: Network, kind: str) -> float:
    """Cross-entropy, or root mean square error of the normalized target."""
    scored = table.withColumn("p", network_output(net, "x", table.sparkSession))
    if kind == "cat":
        return scored.agg(F.avg(-F.log(F.greatest(F.col("p")[F.col("y").cast("int")], F.lit(1e-300))))).first()[0]
    miss = F.col("p")[0] - F.col("y")
    return scored.agg(F.sqrt(F.avg(miss * miss))).first()[0]


def _steps(table: DataFrame, check: DataFrame | None, net: Network, kind: str, penalty: np.ndarray, max_iter: int,
           tol: float, patience: int | None):
    rows = table.select("x", "y", F.lit(False).alias("held"))
    if check is not None:
        rows = rows.unionByName(check.select("x", "y", F.lit(True).alias("held")))
    rows = rows.persist()  # every step reads them; lost blocks are read again from the staged tables
    try:
        return fit_steps(rows, net, kind, penalty, max_iter, tol, patience)
    finally:
        rows.unpersist()


def _on_weights(net: Network, curvature: float) -> np.ndarray:
    """A penalty on the weights of the layers, none on their biases."""
    return np.concatenate([np.concatenate((np.full(np.size(w), curvature), np.zeros(len(b)))) for w, b, _ in net.layers])


def _centred(net: Network, weights_too: bool) -> Network:
    """The same probabilities from biases, and weights, that add to zero over the classes.

    Adding the same to all classes changes nothing; a penalty settles that for the weights, and nothing for the biases.
    """
    (w, b, act), = net.layers
    w, b = np.asarray(w, float), np.asarray(b, float)
    w = w - w.mean(axis=1, keepdims=True) if weights_too else w
    return Network(net.cts, net.cat, [(w.tolist(), (b - b.mean()).tolist(), act)])


def fit_model(train: DataFrame, target: str, kind: str, cts: list[str], cat: list[str], valid: DataFrame | None = None,
              hidden: list[int] = (), l2: float = 0.0, max_iter: int = 100, patience: int | None = None,
              start_from: Fitted | None = None, seed: int = 10, tol: float = TOLERANCE) -> Fitted:
    """Fit ``target`` on continuous and categorical features.

    ``kind`` is "cat" (softmax, cross-entropy) or "cts" (linear, squared error).  ``hidden`` adds sigmoid layers.  Each step is
    one Spark job that also gives the cost of the validation rows; with ``patience`` the fit ends that many steps after the lowest
    one, whose weights are kept.  Step 0 is the start: all zero, random for hidden layers, or
    ``start_from``, whose feature definitions go on.  ``l2`` is the weight of half the squared weights.
    """
    if kind not in ("cat", "cts"):
        raise ValueError("kind must be 'cat' or 'cts'")
    if hidden and (l2 > 0 or kind == "cts"):
        raise ValueError("hidden layers are fitted for categorical targets, without l2")
    if valid is not None and hidden and not patience:
        raise ValueError("validation needs a patience")
    is_cat = kind == "cat"
    defs = start_from.defs if start_from else fit_features(
        train.where(F.col(target).isNotNull()), cts if is_cat else [*cts, target], [*cat, target] if is_cat else cat)
    table = design_table(train, defs, cts, cat, target, kind)
    check = design_table(valid, defs, cts, cat, target, kind) if valid is not None else None
    output = (defs.n_levels[target], "softmax") if is_cat else (1, "linear")
    net = start_from.net if start_from else start_network(
        cts, cat, {}, defs.n_levels, [*[(size, "sigmoid") for size in hidden], output], seed)
    if not hidden and not start_from:
        (w, b, act), = net.layers
        net = Network(cts, cat, [(np.zeros_like(np.asarray(w)).tolist(), b, act)])
    # The mean squared error has twice the curvature of its half, which the penalty belongs to.
    net, costs = _steps(table, check, net, kind, _on_weights(net, l2 if is_cat else 2 * l2), max_iter, tol, patience)
    return Fitted(_centred(net, l2 == 0) if is_cat and not hidden and len(net.layers) == 1 else net, defs, costs)


def fit_network(train: DataFrame, target: str, kind: str, cts: list[str], cat: list[str], layers: list[tuple[int, str]],
                emb: dict[str, int] | None = None, valid: DataFrame | None = None, epochs: int = 20, batch: int | None = None,
                rates: tuple[float, float] = (0.01, 0.001), l2: float = 0.0, patience: int | None = None,
                start_from: Fitted | None = None, seed: int = 10, tol: float = TOLERANCE) -> Fitted:
    """Network of (size, activation) hidden ``layers`` with embedded features ``{name: dimension}``.

    The output layer is added: softmax over the target's levels for "cat", one linear value for "cts".  An epoch is one full-batch
    step, which is one Spark job.  With a ``batch`` size it has a step, and a job, per batch of so many rows, at learning ``rates`` from the first
    to the second.  Costs are cross-entropy, or root mean square error of the normalized target.
    """
    if valid is not None and not patience:
        raise ValueError("validation needs a patience")
    is_cat, emb = kind == "cat", dict(emb or {})
    defs = start_from.defs if start_from else fit_features(
        train.where(F.col(target).isNotNull()), cts if is_cat else [*cts, target],
        [*cat, *emb, *([target] if is_cat else [])])
    table = design_table(train, defs, cts, cat, target, kind, list(emb))
    check = design_table(valid, defs, cts, cat, target, kind, list(emb)) if valid is not None else None
    output = (defs.n_levels[target], "softmax") if is_cat else (1, "linear")
    net = start_from.net if start_from else start_network(cts, cat, emb, defs.n_levels, [*layers, output], seed)
    if batch is None:
        penalty = np.full(len(pack(net)), 2.0 * l2)
        best, costs = _steps(table, check, net, kind, penalty, epochs, tol, patience)
        return Fitted(best, defs, costs)
    held = None if check is None else (lambda now: cost(check, now, kind))
    best, costs = fit_epochs(table, net, kind, epochs, batch, rates, l2, held, patience)
    return Fitted(best, defs, costs)
