"""Feature definitions: fitted once on the model rows, applied anywhere."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanpanel.functions.expr import safe_div
from loanpanel.operators.running import CELLS_PER_TASK, row_positions
from loanpanel.sources.tables import join_small, stage


LISTED_LEVELS = 64  # a feature with no more levels is looked up in an expression, others by a join


@dataclass
class FeatureDefs:
    """Means and deviations, and a (feature, level, idx, n, is_default) table."""

    stats: dict[str, tuple[float, float]]
    levels: DataFrame
    defaults: dict[str, int] = field(default_factory=dict)
    n_levels: dict[str, int] = field(default_factory=dict)
    listed: dict[str, dict[str | None, int]] = field(default_factory=dict)  # index by level, of features with few levels

    def save(self, path: str) -> None:
        spark = self.levels.sparkSession
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")
        text = json.dumps(self.stats)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/stats")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FeatureDefs":
        stats = json.loads(spark.read.text(f"{path}/stats").first()[0])
        return _with_sizes({k: tuple(v) for k, v in stats.items()}, spark.read.parquet(f"{path}/levels"))


def _with_sizes(stats, levels: DataFrame) -> FeatureDefs:
    sizes = levels.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("is_default"), F.col("idx"))).alias("d")).collect()
    few: dict[str, dict[str | None, int]] = {r["feature"]: {} for r in sizes if r["n"] <= LISTED_LEVELS}
    for r in levels.where(F.col("feature").isin(list(few))).select("feature", "level", "idx").collect() if few else []:
        few[r["feature"]][r["level"]] = r["idx"]  # at most LISTED_LEVELS rows a feature
    return FeatureDefs(stats, levels, {r["feature"]: r["d"] for r in sizes}, {r["feature"]: r["n"] for r in sizes}, few)


def listed_index(level: Column, known: dict[str | None, int]) -> Column:
    """Index of a level among few, NULL for others: an expression, no join."""
    pairs = [F.lit(x) for name, idx in sorted((n, i) for n, i in known.items() if n is not None) for x in (name, idx)]
    found = F.try_element_at(F.create_map(*pairs), level) if pairs else F.lit(None).cast("int")
    return F.when(level.isNull(), F.lit(known.get(None)).cast("int")).otherwise(found)


def feature_stats(df: DataFrame, cts: list[str]) -> DataFrame:
    """(feature, mean, sd) from one aggregate over all continuous columns."""
    aggs = []
    for c in cts:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_samp(x).alias(f"s_{c}")]
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("sd"))
                      for c in cts])
    return df.agg(*aggs).select(F.explode(pairs).alias("s")).select("s.*")


def _native_order(df: DataFrame, name: str) -> Column:
    """Numeric columns sort by value; text and dates sort as text."""
    numeric = isinstance(df.schema[name].dataType, T.NumericType)
    return F.col(name).cast("double") if numeric else F.lit(None).cast("double")


def level_counts(df: DataFrame, cat: list[str]) -> DataFrame:
    """(feature, level, n) of all categorical columns from one unpivot and one count."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level"),
                               _native_order(df, c).alias("ord")) for c in cat])
    return (df.select(F.explode(cells).alias("s")).groupBy("s.feature", "s.level", "s.ord")
            .agg(F.count(F.lit(1)).alias("n")))


def level_index(df: DataFrame, cat: list[str], per_task: int = CELLS_PER_TASK) -> DataFrame:
    """Levels numbered 0..K-1 in sorted order; the default is the most frequent one, the first of them on a tie."""
    counts = stage(level_counts(df, cat), "level-counts")
    numbered = row_positions(counts, ["feature"], ["ord", "level"], "idx", per_task)
    modal = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("o"), "ord", "level")).alias("_m"))
    out = join_small(numbered, stage(modal, "modal"), ["feature"])  # one row per feature
    return out.select("feature", "level", "idx", "n", F.col("level").eqNullSafe(F.col("_m.level")).alias("is_default"))


def fit_features(df: DataFrame, cts: list[str], cat: list[str]) -> FeatureDefs:
    stats = {r["feature"]: (r["mean"], r["sd"]) for r in feature_stats(df, cts).collect()} if cts else {}
    schema = "feature string, level string, idx int, n bigint, is_default boolean"
    levels = stage(level_index(df, cat), "levels") if cat else df.sparkSession.createDataFrame([], schema)
    return _with_sizes(stats, levels)


def normalized(c: str, stats: dict[str, tuple[float, float]]) -> Column:
    mean, sd = stats[c]
    return safe_div(F.col(c).cast("double") - F.lit(mean), F.lit(sd or 0.0), 0.0)


def apply_features(df: DataFrame, defs: FeatureDefs, cts: list[str] | None = None,
                   cat: list[str] | None = None, label: str | None = None) -> DataFrame:
    """Add ``z_<c>`` for continuous and ``i_<c>`` for categorical columns.

    An unseen level takes the index of the default level, but for the ``label``, where it stays NULL.  Starts no
    Spark job: the definitions know the number of levels.
    """
    cts = list(defs.stats) if cts is None else cts
    cat = list(defs.n_levels) if cat is None else cat
    out = df.withColumns({f"z_{c}": normalized(c, defs.stats) for c in cts}) if cts else df
    for c in cat:
        if c in defs.listed:
            index = listed_index(F.col(c).cast("string"), defs.listed[c])
            out = out.withColumn(f"i_{c}", index if c == label else F.coalesce(index, F.lit(defs.defaults[c])))
            continue
        own = defs.levels.where(F.col("feature") == c).select(F.col("level").alias("_level"), F.col("idx").alias("_i"))
        out = join_small(out.withColumn("_level", F.col(c).cast("string")), own, ["_level"], "left",
                         rows=defs.n_levels[c])
        index = F.col("_i") if c == label else F.coalesce("_i", F.lit(defs.defaults[c]))
        out = out.withColumn(f"i_{c}", index).drop("_i", "_level")
    return out


def one_hot(index: Column, size: int) -> Column:
    """array<double> with 1.0 at ``index``: one expression, whatever the number of levels."""
    def zeros(n: Column) -> Column:
        return F.array_repeat(F.lit(0.0), n)

    hit = F.concat(zeros(index.cast("int")), F.array(F.lit(1.0)), zeros((F.lit(size - 1) - index).cast("int")))
    return F.when(index.between(0, size - 1), hit).otherwise(zeros(F.lit(size)))


def design(df: DataFrame, defs: FeatureDefs, cts: list[str], cat: list[str], emb: list[str] = (),
           out: str = "features") -> DataFrame:
    """One ``array<double>`` of network inputs with an entry per feature: z-scores, levels, embedded indices.

    A level enters as its place in the one-hot blocks laid end to end, which the first layer looks up.  A NULL
    continuous value enters at its mean.
    """
    parts, before = [F.coalesce(F.col(f"z_{c}"), F.lit(0.0)) for c in cts], 0
    for c in cat:
        parts.append((F.col(f"i_{c}") + F.lit(before)).cast("double"))
        before += defs.n_levels[c]
    parts += [F.col(f"i_{c}").cast("double") for c in emb]
    return df.withColumn(out, F.array(*parts))


def bucket_split(df: DataFrame, where_train=None, where_assess=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(model, validate, assess) rows by hash bucket: 0-9, 10-14, 15-19.

    Extra predicates make the split out-of-time as well.
    """
    model = df.where("bucket < 10")
    valid = df.where("bucket between 10 and 14")
    assess = df.where("bucket >= 15")
    if where_train is not None:
        model, valid = model.where(where_train), valid.where(where_train)
    if where_assess is not None:
        assess = assess.where(where_assess)
    return model, valid, assess


def needed_columns(features: list[str], target: str, slicers: list[str] = (), keep: list[str] = (),
                   extra: list[str] = (), produced: list[str] = ()) -> list[str]:
    """Sorted, deduplicated columns a source must supply; model outputs are not asked of it."""
    return sorted({*features, target, *slicers, *keep, *extra} - set(produced))
