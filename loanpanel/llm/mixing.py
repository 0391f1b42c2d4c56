"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources share ``BUDGET`` times all words by weight, none more than ``CAP`` times its own.  What a source has to give beyond its
complete epochs is a fraction of an epoch: a weighted sample without replacement.  Each document draws an exponential key,
-ln(u) / quality, and documents are taken in the order of their keys until the words are used up.  Only the last document
is cut, between two words, so that a source gives its target to the word.

Keys come from hashes of the row, so reruns agree.  No source is sorted as a whole: words are summed in ranges
of the key, and the range in which the words run out is divided again until it has at most ``CUT_ROWS`` rows; only these
are put in order.  What a document gives then follows from its own key and one row per source.

Cases: a NULL source is a source, the last one.  NULL and empty texts have size 0 and give nothing.  NULL ids are ids like any other.  Rows
alike in id and text have the same key and give the same; if the words run out among them they share what is left.
Words of a text are counted whole, whatever its length.  An empty table stays empty.  Extra columns are kept by ``mix_documents`` and not read by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanpanel.llm.common import written
from loanpanel.sources.tables import join_small

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)  # of the sources in the order of their names, repeating
BUDGET, CAP = 1.5, 2
DIGIT, DIGITS = 10, 5  # bits of a key's place that one round divides by, and rounds
CUT_ROWS = 1 << 20  # rows of a range that are put in order
TYPICAL_WORD = 6.0  # characters of a word of prose, its space included


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def prose_weight(text: Column, size: Column) -> Column:
    """Quality weight in (0, 1]: less the further the mean word is from a typical one."""
    mean = F.greatest(F.length(text), F.lit(1)) / F.greatest(size, F.lit(1))
    return F.coalesce(F.exp(-F.abs(F.log(mean / TYPICAL_WORD))), F.lit(1.0))


def draw_key(doc_id: Column, text: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight with u in (0, 1) from a hash of the row."""
    bits = F.shiftrightunsigned(F.xxhash64(doc_id, F.crc32(text.cast("binary")), F.lit(seed)), 12)
    return -F.log((bits + 0.5) / 2.0**52) / F.greatest(weight, F.lit(1e-6))


def source_targets(sources: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """``target`` words of each row of ``source, source_size``; the rows are as many as there are sources.

    Sources are filled in the order of the level at which they reach their cap.  The level of the others
    is the largest one that is consistent with who is full.
    """
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighed = sources.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    filled = weighed.withColumn("_full", cap * F.col("source_size") / F.col("_w"))
    before = every.orderBy("_full", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    rest = budget * F.sum("source_size").over(every) - F.coalesce(F.sum(cap * F.col("source_size")).over(before), zero)
    level = rest / (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), zero))
    levels = filled.withColumn("_level", level)
    best = F.max(F.when(F.col("_level") <= F.col("_full"), F.col("_level"))).over(every)
    target = F.least(cap * F.col("source_size").cast("double"), best * F.col("_w"))
    return levels.select("source", "source_size", F.coalesce(target, zero).alias("target"))


def _plan(rows: DataFrame) -> DataFrame:
    """What each source gives: ``source, source_size, target, epochs, cut_key, cut_words``.

    Documents with keys below ``cut_key`` are in the fraction, those at it give ``cut_words``.
    """
    # Rises with the key, from 0 to the highest number of DIGIT * DIGITS bits.
    place = F.floor(F.col("_mix_key") / (1 + F.col("_mix_key")) * F.lit(float((1 << DIGIT * DIGITS) - 1))).cast("long")
    rows = rows.select("source", F.col("_mix_size").alias("size"), F.col("_mix_key").alias("key"), place.alias("place"))

    def bin_of(level: int) -> Column:
        return F.shiftright("place", DIGIT * (DIGITS - level))

    def binned(rows: DataFrame, level: int) -> DataFrame:
        return written(rows.groupBy("source", bin_of(level).alias("bin")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")), "bins")

    bins = binned(rows, 1)
    targets = source_targets(bins.groupBy("source").agg(F.sum("words").alias("source_size")))
    epochs = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    targets = targets.withColumn("epochs", epochs)
    targets = written(targets.withColumn("rest", F.round(
        F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")), "targets")

    def running(df: DataFrame, order: str) -> DataFrame:
        over = Window.partitionBy("source").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn("before", F.coalesce(F.sum("words").over(over), F.lit(0)))

    ends = (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))

    def cut_bins(bins: DataFrame, wanted: DataFrame) -> DataFrame:
        return written(join_small(running(bins, "bin"), wanted.select("source", "rest"), ["source"]).where(ends).select(
            "source", F.col("bin").alias("cut_bin"), "n", (F.col("rest") - F.col("before")).alias("rest")), "cut-bins")

    last, near, level = cut_bins(bins, targets), rows, 1
    while True:
        near = join_small(near, last.select("source", "cut_bin", "rest"), ["source"]).where(bin_of(level) == F.col("cut_bin"))
        if level == DIGITS or (last.agg(F.max("n")).first()[0] or 0) <= CUT_ROWS:
            break
        near, level = written(near.select("source", "size", "key", "place"), "near"), level + 1
        last = cut_bins(binned(near, level), last)
    near = near.groupBy("source", "rest", "key").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("alike"))
    cut = running(near, "key").where(ends).select(
        "source", F.col("key").alias("cut_key"),
        F.expr("(rest - before) div alike").alias("cut_words"))
    return join_small(targets, written(cut, "cuts"), ["source"], "left").drop("rest")


def _taken(rows: DataFrame) -> DataFrame:
    """Rows with their source's plan, ``_mix_fraction`` and ``_mix_taken`` words.

    Without a cut the whole source is in the fraction, or nothing is left for one.
    """
    plan = _plan(rows.select("source", "_mix_size", "_mix_key"))
    plan = written(plan.select("source", *[F.col(c).alias(f"_mix_{c}") for c in plan.columns if c != "source"]), "mix-plan")
    planned = join_small(rows, plan, ["source"])
    size, key, cut = F.col("_mix_size"), F.col("_mix_key"), F.col("_mix_cut_key")
    more = F.col("_mix_target") > F.col("_mix_epochs") * F.col("_mix_source_size")
    fraction = (F.when(cut.isNull(), F.when(more, size).otherwise(0)).when(key < cut, size)
                .when(key == cut, F.least(size, F.col("_mix_cut_words"))).otherwise(0))
    return planned.withColumn("_mix_fraction", fraction).withColumn(
        "_mix_taken", F.col("_mix_epochs") * size + F.col("_mix_fraction"))


def _drawn(docs: DataFrame, weight: Column | None, seed: int) -> list[Column]:
    size = words_of(F.col("text"))
    quality = prose_weight(F.col("text"), size) if weight is None else weight
    return [size.alias("_mix_size"), draw_key(F.col("doc_id"), F.col("text"), quality, seed).alias("_mix_key")]


def mix(docs: DataFrame, weight: Column | None = None, seed: int = 7) -> DataFrame:
    """``doc_id, size, source_size, target, taken, epochs`` of every document."""
    rows = written(docs.select("doc_id", "source", *_drawn(docs, weight, seed)), "drawn")
    return _taken(rows).select("doc_id", *[F.col(f"_mix_{c}").alias(c) for c in
                                           ("size", "source_size", "target", "taken", "epochs")])


def mix_documents(docs: DataFrame, weight: Column | None = None, seed: int = 7) -> DataFrame:
    """The mixture itself: a row per copy, with the columns of ``docs``; the cut document is shortened."""
    chosen = _taken(written(docs.select("*", *_drawn(docs, weight, seed)), "drawn-texts"))
    part = F.col("_mix_fraction")
    cut = (part > 0) & (part < F.col("_mix_size"))
    whole = F.col("_mix_epochs") + ((part > 0) & ~cut).cast("long")
    words = F.concat(F.lit(r"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){"), part.cast("string"), F.lit("}+"))
    shortened = F.when(F.col("_mix_cut"), F.call_function("regexp_extract", F.col("text"), words, F.lit(0))).otherwise(F.col("text"))
    flags = F.concat(F.array_repeat(F.lit(False), whole.cast("int")), F.array_repeat(F.lit(True), cut.cast("int")))
    rows = chosen.select("*", F.explode(flags).alias("_mix_cut")).withColumn("text", shortened)
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
