"""Scoring with fixed network parameters, as Arrow batches.

Only the input array travels to Python; the other columns stay in the JVM.
"""

from __future__ import annotations

import json
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanpanel.functions.expr import log_odds, sum_of
from loanpanel.operators.features import FeatureDefs, apply_features, design

LEAK = 0.01

# Executors get the scoring function itself: they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Network:
    """Dense layers on [z-scores, a row of the first layer per level, embedded features].

    ``layers`` are (weights in x out, bias, activation); ``tables`` holds one
    levels x dim matrix per embedded feature.
    """

    cts: list[str]
    cat: list[str]
    layers: list[tuple[list[list[float]], list[float], str]]
    emb: list[str] = field(default_factory=list)
    tables: list[list[list[float]]] = field(default_factory=list)

    @property
    def features(self) -> list[str]:
        return [*self.cts, *self.cat, *self.emb]

    @property
    def n_out(self) -> int:
        return len(self.layers[-1][1])

    def with_bias(self, shift: list[float]) -> "Network":
        """Add ``shift`` to the output bias.

        Adjustments are relative to the last class, which keeps its bias.
        """
        *head, (w, b, act) = self.layers
        moved = [*shift, *[0.0] * (len(b) - len(shift))]
        return Network(self.cts, self.cat, [*head, (w, [x + y for x, y in zip(b, moved)], act)], self.emb, self.tables)

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps(self.__dict__)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Network":
        net = Network(**json.loads(spark.read.text(path).first()[0]))
        net.layers = [tuple(layer) for layer in net.layers]
        return net


def _activate(x: np.ndarray, act: str) -> np.ndarray:
    if act == "relu":
        return np.maximum(x, 0.0)
    if act == "leaky_relu":
        return np.where(x > 0, x, LEAK * x)
    if act == "sigmoid":
        return 1.0 / (1.0 + np.exp(-x))
    if act == "softmax":
        e = np.exp(x - x.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    if act == "linear":
        return x
    raise ValueError(f"unknown activation {act}")


def first_inputs(x: np.ndarray, tables, n_cat: int):
    """Parts of a design row: (continuous values, rows of the first layer that the levels pick, embedded indices, embedded values).

    The first layer has a row for each continuous value, then one per level, then one for each embedded value.
    """
    k = len(tables)
    n_cts = x.shape[1] - n_cat - k
    index = x[:, x.shape[1] - k:].astype(int)
    embedded = np.hstack([t[index[:, j]] for j, t in enumerate(tables)]) if k else np.empty((len(x), 0))
    return x[:, :n_cts], x[:, n_cts:n_cts + n_cat].astype(int) + n_cts, index, embedded


def first_sums(w: np.ndarray, b: np.ndarray, values: np.ndarray, rows: np.ndarray, embedded: np.ndarray) -> np.ndarray:
    """First layer before its activation: a level adds its row of the weights, so no one-hot block is built."""
    out = values @ w[:values.shape[1]] + b
    for j in range(rows.shape[1]):
        out += w[rows[:, j]]
    return out + embedded @ w[len(w) - embedded.shape[1]:] if embedded.shape[1] else out


def forward(layers, tables, x: np.ndarray, n_cat: int = 0) -> np.ndarray:
    """Network output for a batch of design rows: continuous values, ``n_cat`` level rows, embedded indices."""
    (w, b, act), *rest = layers
    values, rows, _, embedded = first_inputs(x, tables, n_cat)
    out = _activate(first_sums(w, b, values, rows, embedded), act)
    for w, b, act in rest:
        out = _activate(out @ w + b, act)
    return out


def network_output(net: Network, features: str, spark: SparkSession) -> Column:
    """``array<double>`` of class probabilities, or of one value for a linear output."""
    params = spark.sparkContext.broadcast((
        [(np.asarray(w, dtype=float), np.asarray(b, dtype=float), act) for w, b, act in net.layers],
        [np.asarray(t, dtype=float) for t in net.tables],
    ))
    width, n_cat = net.n_out, len(net.cat)

    @F.arrow_udf(returnType=T.ArrayType(T.DoubleType()))
    def score(inputs: pa.Array) -> pa.Array:
        n = len(inputs)
        flat = inputs.flatten().to_numpy(zero_copy_only=False)
        layers, tables = params.value
        out = forward(layers, tables, flat.reshape(n, -1), n_cat) if n else np.empty((0, width))
        ends = pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32))
        return pa.ListArray.from_arrays(ends, pa.array(out.ravel()))

    return score(F.col(features))


def score_network(df: DataFrame, net: Network, defs: FeatureDefs, out: str = "probs") -> DataFrame:
    """Add the network output as ``array<double>``; all other columns are kept as they are."""
    ready = apply_features(df, defs, net.cts, [*net.cat, *net.emb])
    ready = design(ready, defs, net.cts, net.cat, net.emb, "_x")
    scored = ready.withColumn(out, network_output(net, "_x", df.sparkSession))
    return scored.select(*[c for c in df.columns if c != out], out)


def output_sum(cols: list[int], probs: str = "probs") -> Column:
    """Sum of the listed output columns."""
    return sum_of([F.col(probs)[c] for c in cols])


def coalesce_target(df: DataFrame, cols: list[int], probs: str = "probs", obs: str = "obs_class") -> DataFrame:
    """Binary view of a multi-class model: ``fit`` = summed probabilities, ``obs`` = 1 for the listed classes."""
    seen = F.when(F.col(obs).isin(*cols), F.lit(1.0)).otherwise(F.lit(0.0))
    return df.withColumns({"fit": output_sum(cols, probs), "obs": seen})


def continuous_target(df: DataFrame, target: str, stats: dict[str, tuple[float, float]],
                      probs: str = "probs") -> DataFrame:
    """Regression view: the output is put back on the scale of the target."""
    mean, sd = stats[target]
    return df.withColumns({"fit": F.col(probs)[0] * F.lit(sd) + F.lit(mean), "obs": F.col(target).cast("double")})


@dataclass
class InputModel:
    """A fitted model whose outputs are features of another one.

    ``outputs`` names sums of output columns.  Its own input models run first.
    """

    net: Network
    defs: FeatureDefs
    outputs: dict[str, list[int]]
    inputs: list["InputModel"] = field(default_factory=list)


def save_inputs(spark: SparkSession, inputs: list[InputModel], path: str) -> None:
    """Input models below ``path``, each with its own input models."""
    for k, m in enumerate(inputs):
        m.net.save(spark, f"{path}/input-{k}/network")
        m.defs.save(f"{path}/input-{k}/features")
        save_inputs(spark, m.inputs, f"{path}/input-{k}")
    named = json.dumps([m.outputs for m in inputs])
    spark.createDataFrame([(named,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/inputs")


def load_inputs(spark: SparkSession, path: str) -> list[InputModel]:
    named = json.loads(spark.read.text(f"{path}/inputs").first()[0])
    return [InputModel(Network.load(spark, f"{path}/input-{k}/network"), FeatureDefs.load(spark, f"{path}/input-{k}/features"),
                       outputs, load_inputs(spark, f"{path}/input-{k}")) for k, outputs in enumerate(named)]


def add_input_models(df: DataFrame, models: list[InputModel]) -> DataFrame:
    """Add every model's named outputs, as log odds, innermost models first."""
    out = df
    for m in models:
        out = add_input_models(out, m.inputs)
        scored = score_network(out, m.net, m.defs, "_out")
        out = scored.withColumns({n: log_odds(output_sum(c, "_out")) for n, c in m.outputs.items()}).drop("_out")
    return out


def input_columns(models: list[InputModel]) -> tuple[set[str], set[str]]:
    """(source columns the models read, columns they make), submodels included."""
    need: set[str] = set()
    made: set[str] = set()
    for m in models:
        inner_need, inner_made = input_columns(m.inputs)
        made |= inner_made | set(m.outputs)
        need |= inner_need | set(m.net.features)
    return need - made, made


def with_outputs(df: DataFrame, outputs: dict[str, list[int]], probs: str = "probs") -> DataFrame:
    """Named sums of output columns, as probabilities."""
    return df.withColumns({name: output_sum(cols, probs) for name, cols in outputs.items()})


def export_scored(df: DataFrame, outputs: dict[str, list[int]], path: str, probs: str = "probs") -> None:
    """Write the assessed rows with their named model outputs."""
    with_outputs(df, outputs, probs).drop(probs).write.mode("overwrite").parquet(path)
