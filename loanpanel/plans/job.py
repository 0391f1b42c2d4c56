"""A whole run as one typed object: build the data, fit, correct the bias, assess.

A phase runs when its block is set.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanpanel.operators.assessment import assess_all
from loanpanel.operators.calibrate import fit_bias
from loanpanel.operators.econ import BASE_MONTH, add_economics
from loanpanel.operators.features import apply_features, needed_columns
from loanpanel.operators.models import Fitted, fit_model, fit_network
from loanpanel.operators.network import (
    InputModel,
    add_input_models,
    coalesce_target,
    continuous_target,
    export_scored,
    input_columns,
    score_network,
)
from loanpanel.operators.panel import AS_OF_COLUMNS, as_of_panel, sample_as_of
from loanpanel.operators.sampling import SEED, strata_rates, stratified_sample
from loanpanel.operators.targets import (
    COVID,
    FIRST_PERIOD,
    MAX_FORECAST,
    carried_columns,
    draw_targets,
    uncensored,
    window_rows,
)
from loanpanel.session import tune
from loanpanel.sources.profile import SourceProfile
from loanpanel.sources.tables import source_query, stage, write_sorted

Where = Column | str | None
Source = DataFrame | str


@dataclass
class Stage:
    """One sampling pass: strata, target size, predicate, where to keep its tables."""

    strata: list[str]
    n: int
    where: Where = None
    sample_out: str | None = None
    strata_out: str | None = None


@dataclass
class DataBlock:
    loans: DataFrame
    profile: SourceProfile
    econ: DataFrame
    stage1: Stage
    stage2: Stage
    out: str
    geo: str = "zip3"
    base_month: dt.date = BASE_MONTH
    window_months: int | None = None
    censor_guard: bool = False
    sort_key: str | None = None
    covid: tuple[dt.date, dt.date] = COVID
    first_period: int = FIRST_PERIOD
    seed: int = SEED
    exact: bool = False


@dataclass
class ModelBlock:
    train: Source
    target: str
    kind: str
    cts: list[str] = field(default_factory=list)
    cat: list[str] = field(default_factory=list)
    valid: Source | None = None
    hidden: list[int] = field(default_factory=list)  # sigmoid layers
    layers: list[tuple[int, str]] = field(default_factory=list)  # (size, activation)
    emb: dict[str, int] = field(default_factory=dict)  # embedded feature: dimension
    l2: float = 0.0
    max_iter: int = 100  # iterations, or epochs
    batch_size: int | None = None  # of layers and embeddings: rows of a step, which is one Spark job; all rows by default
    learning_rate: tuple[float, float] = (0.01, 0.001)
    patience: int | None = None
    start_from: Fitted | None = None


@dataclass
class AssessBlock:
    source: Source
    ids: list[str]
    by_feature: list[tuple[str, list[int], str]] = field(default_factory=list)
    curves: list[tuple[str, list[int], str]] = field(default_factory=list)
    extra_features: list[str] = field(default_factory=list)
    extra_cat: list[str] = field(default_factory=list)
    save_to: str | None = None
    save_outputs: dict[str, list[int]] = field(default_factory=dict)
    marginals: bool = False


@dataclass
class Job:
    title: str
    out_dir: str
    data: DataBlock | None = None
    model: ModelBlock | None = None
    bias: Source | None = None
    assess: AssessBlock | None = None
    fitted: Fitted | None = None  # an existing model, when none is fitted here
    target: str | None = None  # its target and kind
    kind: str = "cat"
    input_models: list[InputModel] = field(default_factory=list)
    keep: list[str] = field(default_factory=list)


@dataclass
class Result:
    data: DataFrame | None = None
    fitted: Fitted | None = None
    shift: list[float] | None = None
    tables: dict[str, DataFrame] = field(default_factory=dict)


def _kept(at: Stage, drawn: DataFrame, label: str) -> DataFrame:
    """The drawn sample, written: to its own path when named, to a staged table otherwise."""
    if not at.sample_out:
        return stage(drawn, label)
    drawn.write.mode("overwrite").parquet(at.sample_out)
    return drawn.sparkSession.read.schema(drawn.schema).parquet(at.sample_out)


def _rates(at: Stage, rows: DataFrame, label: str) -> DataFrame:
    return _kept_rates(at, stage(strata_rates(rows, at.strata, at.n), f"{label}-strata"))


def _kept_rates(at: Stage, rates: DataFrame) -> DataFrame:
    if at.strata_out:
        rates.write.mode("overwrite").parquet(at.strata_out)
    return rates


def build_data(block: DataBlock) -> DataFrame:
    """Two-stage sample, then economics; the pair table is never stored.

    Pass 1 rows keep the part of their history that pass 2 can reach, so with a
    moderate number of strata the loan table is scanned twice and never
    shuffled.  Pass 2 explodes that staged sample once, for the strata counts and the draw.
    """
    one, two, profile = block.stage1, block.stage2, block.profile
    era = {"covid": block.covid, "first_period": block.first_period}
    reach = block.window_months or MAX_FORECAST
    extra = tuple(c for c in one.strata if c not in AS_OF_COLUMNS)
    rates = _rates(one, as_of_panel(block.loans, profile, one.where, extra), "pass1")
    rows = stage(sample_as_of(block.loans, profile, one.strata, one.n, one.where, seed=block.seed, exact=block.exact,
                              rates=rates, history_months=reach), "pass1")
    if one.sample_out:
        rows.select("loan_id", *[c for c in (*AS_OF_COLUMNS, *extra) if c in rows.columns]).write.mode(
            "overwrite").parquet(one.sample_out)
    if block.window_months and block.censor_guard:
        rows = uncensored(rows, block.loans, block.window_months)
    joined = rows.select(*carried_columns(profile), "monthly", "_offset")
    if block.window_months:
        pairs = stage(window_rows(joined, block.window_months, two.where, **era), "window")
        drawn = stratified_sample(pairs, two.strata, two.n, ["loan_id", "ao_dt", "trg_dt"], block.seed, block.exact,
                                  _rates(two, pairs, "pass2"))
    else:
        drawn, rates = draw_targets(joined, profile, two.strata, two.n, two.where, seed=block.seed, exact=block.exact, **era)
        _kept_rates(two, rates)
    full = add_economics(_kept(two, drawn, "pass2"), block.econ, block.geo, block.base_month)
    write_sorted(full, block.out, block.sort_key)
    return full.sparkSession.read.schema(full.schema).parquet(block.out)


def run(spark: SparkSession, job: Job) -> Result:
    """Run the phases whose blocks are set, in order."""
    if not any((job.data, job.model, job.bias, job.assess)):
        raise ValueError("set at least one of data, model, bias, assess")
    tune(spark)
    result = Result(fitted=job.fitted)
    if job.data:
        result.data = build_data(job.data)
    inputs = job.input_models or (job.fitted.inputs if job.fitted else [])
    own, made = input_columns(inputs)
    target = job.model.target if job.model else job.target
    kind = job.model.kind if job.model else job.kind

    def rows(source: Source, features: list[str], more: list[str] = ()) -> DataFrame:
        need = needed_columns([*features, *own], target, keep=[*job.keep, *more], produced=list(made))
        return add_input_models(source_query(spark, source, need), inputs)

    if job.model:
        m = job.model
        features = [*m.cts, *m.cat, *m.emb]
        valid = rows(m.valid, features) if m.valid is not None else None
        if m.layers or m.emb:
            result.fitted = fit_network(rows(m.train, features), m.target, m.kind, m.cts, m.cat, m.layers, m.emb, valid,
                                        m.max_iter, m.batch_size, m.learning_rate, m.l2, m.patience, m.start_from)
        else:
            result.fitted = fit_model(rows(m.train, features), m.target, m.kind, m.cts, m.cat, valid, m.hidden, m.l2,
                                      m.max_iter, m.patience, start_from=m.start_from)
        result.fitted.inputs = inputs
        result.fitted.save(spark, f"{job.out_dir}/model")
    if (job.bias is not None or job.assess) and (result.fitted is None or target is None):
        raise ValueError("bias and assess need a model: set model, or fitted and target")
    if job.bias is not None:
        f = result.fitted
        if f.net.layers[-1][2] != "softmax":
            raise ValueError("bias correction needs a softmax output")
        # Written: every Newton step reads it, and scoring is the dear part.
        scored = stage(_scored(rows(job.bias, f.net.features), f, target).select("probs", "obs_class"), "bias")
        result.shift, _ = fit_bias(scored, f.net.n_out)
        result.fitted = Fitted(f.net.with_bias(result.shift), f.defs, f.costs, inputs)
        result.fitted.save(spark, f"{job.out_dir}/model-bias")
    if job.assess:
        result.tables = _assess(job.assess, result.fitted, rows, target, kind, job.keep)
    return result


def _scored(df: DataFrame, fitted: Fitted, target: str, kind: str = "cat") -> DataFrame:
    scored = score_network(df, fitted.net, fitted.defs)
    if kind != "cat":
        return scored
    # NULL for a class that the model does not know.
    return apply_features(scored, fitted.defs, [], [target], target).withColumnRenamed(f"i_{target}", "obs_class")


def _assess(block: AssessBlock, fitted: Fitted, rows, target: str, kind: str, keep: list[str]) -> dict[str, DataFrame]:
    net, defs = fitted.net, fitted.defs
    slicers = [s for _, _, s in [*block.by_feature, *block.curves] if s != "no_groups"]
    extra = [*block.extra_features, *block.extra_cat]
    source = rows(block.source, net.features, [*slicers, *extra, *block.ids])
    scored = stage(_scored(source, fitted, target, kind), "assess")
    cts = [*net.cts, *[c for c in block.extra_features if c not in block.extra_cat]]
    cat = [*net.cat, *net.emb, *block.extra_cat]
    view = coalesce_target if kind == "cat" else (lambda df, _: continuous_target(df, target, defs.stats))
    scorer = (lambda df: score_network(df, net, defs)) if block.marginals else None
    out = assess_all(scored, block.by_feature, block.ids, cat, cts, block.curves, view, kind != "cat", scorer)
    if block.save_to:
        export_scored(scored, block.save_outputs, block.save_to)
    return out
