"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the budget by its weight. A source can give no more than `epochs` times its words; what
it cannot give is shared among the others by weight, again and again until no target is above its cap. A document
is then repeated target / size times: the whole part for every document of the source, the rest for those with
the lowest seeded draws, as many as make up the missing words. Where a long document ends this early, the cut is made again
among the draws beyond it and the documents that still fit, until less is missing than an ordinary document has; one that
fits this best is taken last. A cut is found with histograms of the draws' bits, so no source, however large, is sorted
or gathered.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from claimflow.llm.common import save
from claimflow.llm.words import word_count

EPOCHS = 3
SEED = 42
LEVEL_BITS = 10  # bits of a draw that a histogram tells apart
LEVELS = 3
DRAWS = 1 << LEVEL_BITS * LEVELS
NEAR = 1e-5  # a source whose missing words are a smaller share of its target gets no further cut


def _same_source(a: DataFrame, b: DataFrame) -> Column:
    return a["source"].eqNullSafe(b["source"])


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, weight) of the distinct values in `source`: by code point, null last, the weights in turn.

    The window has no key: it numbers the list of sources, one row for each, not the documents.
    """
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = sources.select("source").distinct()
    return listed.select("source", F.element_at(F.array(*[F.lit(w) for w in weights]), (at % len(weights)) + 1).cast("long").alias("weight"))


def water_fill(sources: DataFrame, epochs: int = EPOCHS, budget: int | None = None) -> DataFrame:
    """Add `target` (double) to one row per source (source, weight long, source_size long).

    budget: words to share out, by default the sum of all sizes. A round is one sum over the sources; only its two
    numbers reach the driver. Sources of no words, or of weight 0 or null, get 0.
    """
    sources = sources.withColumn("weight", F.coalesce("weight", F.lit(0)).cast("long"))
    cap = F.col("source_size") * epochs
    if budget is None:
        budget = sources.agg(F.sum("source_size")).first()[0] or 0
    water, weight, clamped, full = budget, None, F.lit(False), 0
    while True:
        row = sources.agg(
            F.sum(F.when(clamped, cap).otherwise(0)).alias("full"),
            F.sum(F.when(clamped, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        full, open_weight = row["full"] or 0, row["weight"] or 0
        if open_weight == weight or not open_weight:
            weight = open_weight
            break
        water, weight = budget - full, open_weight
        # weight * water / open_weight > cap, in whole numbers of any length
        over = F.col("weight").cast("decimal(38,0)") * F.lit(str(water)).cast("decimal(38,0)") > cap.cast("decimal(38,0)") * F.lit(
            str(open_weight)
        ).cast("decimal(38,0)")
        clamped = over & (F.col("weight") > 0)
    share = F.col("weight").cast("double") * (F.lit(float(water)) / F.lit(float(max(weight, 1))))
    return sources.withColumn(
        "target", F.when(clamped, cap.cast("double")).otherwise(F.least(share, cap.cast("double"))).cast("double")
    )


def _cut(docs: DataFrame, wanted: DataFrame, level: int) -> DataFrame:
    """Per source the bucket of this level that the missing words end in, and the words still missing there."""
    shift = LEVEL_BITS * (LEVELS - 1 - level)
    bucket = F.shiftright("draw", shift).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1))
    sums = docs.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    sums = save(sums, "mixing-histogram")
    wanted = wanted.select("source", "low", "missing")
    joined = sums.join(wanted, _same_source(sums, wanted)).drop(wanted["source"])
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    joined = joined.withColumn("before", upto - F.col("words")).withColumn("upto", upto)
    ends = joined.where((F.col("before") < F.col("missing")) & (F.col("upto") >= F.col("missing")))
    low = F.col("low") + F.shiftleft(F.col("bucket").cast("long"), shift)
    return ends.select("source", low.alias("low"), (F.col("missing") - F.col("before")).alias("missing"), "words")


def _draw(seed: int, doc_id: str, text: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)), 64 - LEVEL_BITS * LEVELS)


def _plan(
    docs: DataFrame, weights: DataFrame | None, epochs: int, budget: int | None, seed: int, doc_id: str, text: str, source: str
) -> tuple[DataFrame, DataFrame]:
    """Rows without their texts, and per source the target, the whole repetitions and the draw below which one more is due."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        _draw(seed, doc_id, text).alias("draw"),
    )
    rows = save(rows, "mixing-rows")
    sizes = save(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")), "mixing-sources")
    weights = cyclic_weights(sizes) if weights is None else weights
    weighted = sizes.join(weights, _same_source(sizes, weights), "left").drop(weights["source"])
    targets = water_fill(save(weighted, "mixing-weights"), epochs, budget)
    size = F.col("source_size")
    whole = F.when(size > 0, F.least(F.floor(F.col("target") / size), F.lit(epochs))).otherwise(0).cast("long")
    targets = save(targets.withColumn("whole", whole), "mixing-targets")

    rest = F.col("target") - F.col("whole") * size
    ordinary = F.greatest(size / F.col("rows"), NEAR * F.col("target"), F.lit(1.0))
    wanted = targets.where(rest > 0).select("source", rest.alias("missing"), ordinary.alias("ordinary"))
    spans, gaps = _cuts(rows.where(F.col("size") > 0).select("source", "size", "draw"), save(wanted, "mixing-wanted"))
    spans = save(spans.groupBy("source").agg(F.collect_list(F.struct("low", "high", "largest")).alias("spans")), "mixing-spans")
    # what is still missing comes from the one draw beyond that fits it best
    left = spans.join(gaps, _same_source(spans, gaps)).select(spans["source"].alias("__left"), "spans", "missing")
    beyond = rows.where(F.col("size") > 0).join(left, rows["source"].eqNullSafe(left["__left"]))
    beyond = beyond.where(~_within("spans", F.col("draw"), F.col("size")) & (F.col("size") < 2 * F.col("missing")))
    words = beyond.groupBy("source", "draw", "missing").agg(F.sum("size").alias("words"))
    misses = F.abs(F.col("words") - F.col("missing"))
    fitting = words.where(misses < F.col("missing")).groupBy(F.col("source").alias("__fit"), "missing")
    last = fitting.agg(F.min_by("draw", F.struct(misses, F.col("draw"))).cast("long").alias("low"))
    fits = (F.ceil(2 * F.col("missing")) - 1).cast("long")
    last = save(last.select("__fit", F.array(F.struct("low", (F.col("low") + 1).alias("high"), fits.alias("largest"))).alias("last")), "mixing-last")
    plan = targets.join(spans.withColumnRenamed("source", "__cut"), targets["source"].eqNullSafe(F.col("__cut")), "left")
    plan = plan.join(last, plan["source"].eqNullSafe(last["__fit"]), "left")
    due = F.when(F.col("last").isNull(), F.col("spans")).otherwise(F.concat("spans", "last"))
    plan = save(plan.select(F.col("source").alias("__source"), "source_size", "target", "whole", due.alias("__spans")), "mixing-plan")
    return rows, plan


def _within(spans: str, draw: Column, size: Column) -> Column:
    return F.exists(spans, lambda s: (draw >= s["low"]) & (draw < s["high"]) & (size <= s["largest"]))


def _cuts(rows: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans (source, low, high, largest) of what is due once more, and the words that are then missing (source, missing).

    rows: (source, size, draw); wanted: (source, missing, ordinary). A span holds the draws from low to below high of texts of at
    most `largest` words. The first takes all texts; the next begins beyond the draw that did not fit, without the texts
    that are longer than what is missing, and so on until that is no more than an ordinary text or no draw is left.
    """
    open_ = wanted.select("*", F.lit(0).cast("long").alias("from"), F.lit(2**62).alias("largest"))
    spans, gaps = [], []
    while True:
        bounds = open_.select(F.col("source").alias("__open"), "from", "largest")
        fits = rows["source"].eqNullSafe(bounds["__open"]) & (F.col("draw") >= F.col("from")) & (F.col("size") <= F.col("largest"))
        part = rows.join(bounds, fits).select("source", "size", "draw")
        total = save(part.groupBy(F.col("source").alias("__total")).agg(F.sum("size").alias("words")), "mixing-total")
        met = open_.join(total, open_["source"].eqNullSafe(total["__total"]), "left").drop("__total")
        met = save(met.withColumn("words", F.coalesce("words", F.lit(0))), "mixing-open")
        all_ = met.where("words < missing").select("source", F.lit(DRAWS).cast("long").alias("low"), (F.col("missing") - F.col("words")).alias("missing"))
        cut = met.where("words >= missing").select("source", F.lit(0).cast("long").alias("low"), "missing")
        for level in range(LEVELS):
            cut = save(_cut(part, cut, level).drop("words"), "mixing-cut")
            below = LEVEL_BITS * (LEVELS - 1 - level)
            inside = cut.select(F.col("source").alias("__source"), F.shiftright("low", below).alias("__at"))
            same = part["source"].eqNullSafe(inside["__source"]) & (F.shiftright(part["draw"], below) == inside["__at"])
            part = part.join(inside, same).select("source", "size", "draw")
        ends = cut.unionByName(all_).select(F.col("source").alias("__end"), F.col("low").alias("high"), F.col("missing").alias("gap"))
        ended = save(met.join(ends, met["source"].eqNullSafe(ends["__end"])), "mixing-ended")
        spans.append(ended.select("source", F.col("from").alias("low"), "high", "largest"))
        again = (F.col("gap") > F.col("ordinary")) & (F.col("high") < DRAWS - 1)
        gaps.append(ended.where(~again).select("source", F.col("gap").alias("missing")))
        longest = F.floor("gap").cast("long")
        open_ = ended.where(again).select("source", F.col("gap").alias("missing"), "ordinary", (F.col("high") + 1).alias("from"), longest.alias("largest"))
        if open_.isEmpty():
            return functools.reduce(DataFrame.unionByName, spans), functools.reduce(DataFrame.unionByName, gaps)


def _times(whole: str, draw: str, size: Column) -> Column:
    due = F.coalesce(_within("__spans", F.col(draw), size), F.lit(False))
    return F.col(whole) + F.when(due, 1).otherwise(0)


def repetitions(
    docs: DataFrame,
    weights: DataFrame | None = None,
    epochs: int = EPOCHS,
    budget: int | None = None,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, times, taken (= size * times).

    size: words of the text (null: 0). Null is a source of its own. weights: (source, weight), by default 1, 2, 3
    in turn over the sources by code point, null last. budget: words in all, by default the sum of all sizes. A
    row's draw comes from the seed, its doc_id and its text, so reruns agree and repeated rows are taken alike. A
    source's taken words miss its target by less than an ordinary text of it has, as long as texts that fit are left, mostly
    by a few. Texts without words are taken as often as others of their draw; a source without any words has target 0.
    An empty table gives no rows.
    """
    rows, plan = _plan(docs, weights, epochs, budget, seed, doc_id, text, source)
    return (
        rows.join(plan, rows["source"].eqNullSafe(plan["__source"]))
        .withColumn("times", _times("whole", "draw", F.col("size")).cast("long"))
        .select(
            "doc_id", "source", "size", "source_size", "target", "times", (F.col("size") * F.col("times")).alias("taken")
        )
    )


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    epochs: int = EPOCHS,
    budget: int | None = None,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The rows of `docs`, all columns, each as often as `repetitions` says, with its rules for nulls, repeats and no words."""
    _, plan = _plan(docs, weights, epochs, budget, seed, doc_id, text, source)
    plan = plan.select("__source", F.col("whole").alias("__whole"), "__spans")
    drawn = docs.withColumns({"__draw": _draw(seed, doc_id, text), "__size": word_count(F.col(text))})
    copies = F.explode(F.array_repeat(F.lit(1), _times("__whole", "__draw", F.col("__size")).cast("int")))
    return drawn.join(plan, drawn[source].eqNullSafe(plan["__source"])).select(*docs.columns, copies.alias("__copy")).drop("__copy")
