"""Mixing sources to target weights by entropy balancing.

The rates closest to one copy a document, in relative entropy, under one word constraint a source and
a ceiling are ``min(ceiling, exp(lambda * size))``; the multipliers solve a convex dual, whose gradient
and curvature each Newton step sums over all documents. Documents of a source and size share a rate,
so the sums run over a histogram.

Cases: a null text has size 0; a null source is a source of its own, last in order; documents of size 0
are kept once and take no words; repeated rows are separate documents; ties among equal documents go by
a hash of key and text, then the key; an empty table gives no rows; of other columns only ``keep`` is read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ankenmart.llm.common import n_words, saved, text_of

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CEILING = 2.0
SALTS = 256
TOLERANCE = 1e-7
MOST_STEPS = 60


def targets(totals: DataFrame, weights: tuple[float, ...], share: float, ceiling: float) -> DataFrame:
    """Adds ``target`` to one row a source (source, source_size, n): weighted shares of ``share`` times
    all words, none above ``ceiling`` times its source, the excess reshared by weight.

    Resharing ends at ``min(ceiling * size, level * weight)`` for one common level. Taking the k sources
    that fill up first as full gives a level never above it, and it for the right k.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int"))
    by_fill = W.orderBy(F.col("full") / F.col("weight"), "id")
    level = (F.col("wanted") - (F.sum("full").over(by_fill) - F.col("full"))) / F.sum("weight").over(
        by_fill.rowsBetween(0, W.unboundedFollowing)
    )
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return (
        totals.withColumn("id", F.row_number().over(order))
        .withColumn("weight", weight)
        .withColumn("full", ceiling * F.col("source_size"))
        .withColumn("wanted", share * F.sum("source_size").over(every))
        .withColumn("level", level)
        .withColumn("target", F.least("full", F.max("level").over(every) * F.col("weight")))
        .drop("level", "wanted", "weight", "id")
    )


def _rate(ceiling: float) -> Column:
    return F.least(F.lit(ceiling), F.exp(F.col("multiplier") * F.col("size") / F.col("unit")))


def balance(histogram: DataFrame, sources: DataFrame, ceiling: float) -> DataFrame:
    """Newton's method on the dual, all sources at once; sources gains ``multiplier`` and ``unit``.

    A step outside the bracket known so far is replaced by its middle. State is one row a source.
    """
    shortest = histogram.where("size > 0").groupBy("source_key").agg(F.min("size").alias("shortest"))
    ratio = F.greatest(F.col("target"), F.lit(1e-9)) / F.greatest(F.col("source_size"), F.lit(1))
    state = (
        sources.join(shortest, "source_key", "left")
        .withColumn("unit", F.greatest(F.col("source_size"), F.lit(1)) / F.col("n"))
        .withColumn("low", F.least(F.lit(0.0), F.ln(ratio)) * F.col("unit") / F.coalesce("shortest", F.lit(1)))
        .withColumn("high", F.ln(F.lit(ceiling)) * F.col("unit") / F.coalesce("shortest", F.lit(1)) * 1.000001)
        .withColumn("multiplier", F.when(F.col("target") >= F.col("full") * (1 - 1e-12), F.col("high")).otherwise(F.ln(ratio)))
        .withColumn("off", F.lit(1.0))
        .drop("shortest")
    )
    kept = [c for c in state.columns if c not in ("source_key", "low", "high", "multiplier", "off")]
    state = saved(state, "balance")
    for _ in range(MOST_STEPS):
        rate, x = _rate(ceiling), F.col("size") / F.col("unit")
        words = F.col("n_size") * F.col("size")
        steps = (
            histogram.join(state, "source_key")
            .groupBy("source_key")
            .agg(
                F.sum(words * rate).alias("got"),
                F.sum(F.when(rate < ceiling, words * x * rate).otherwise(0.0)).alias("slope"),
                *(F.first(c).alias(c) for c in (*kept, "low", "high", "multiplier")),
            )
            .withColumn("off", F.abs(F.col("got") - F.col("target")) / F.greatest(F.col("target"), F.lit(1.0)))
            .withColumn("high", F.when(F.col("got") > F.col("target"), F.col("multiplier")).otherwise(F.col("high")))
            .withColumn("low", F.when(F.col("got") < F.col("target"), F.col("multiplier")).otherwise(F.col("low")))
            .withColumn("step", F.col("multiplier") - (F.col("got") - F.col("target")) / F.when(F.col("slope") > 0, F.col("slope")))
            .withColumn(
                "multiplier",
                F.when(F.col("off") <= TOLERANCE, F.col("multiplier"))
                .when((F.col("step") > F.col("low")) & (F.col("step") < F.col("high")), F.col("step"))
                .otherwise((F.col("low") + F.col("high")) / 2),
            )
        )
        state = saved(steps.select(state.columns), "balance")
        if (state.agg(F.max("off")).first()[0] or 0.0) <= TOLERANCE:
            break
    return state


def _copies(frame: pd.DataFrame) -> pd.DataFrame:
    """Whole copies for each size of a source, longest first, the words still owed carried along.

    One row a distinct size, so at most as many as the longest document has words.
    """
    frame = frame.sort_values("size", ascending=False)
    owed, most = 0.0, float(frame["ceiling"].iloc[0])
    out = []
    for size, n, rate in zip(frame["size"], frame["n_size"], frame["rate"], strict=True):
        if size == 0:
            out.append(n)
            continue
        owed += n * rate * size
        copies = min(max(int(owed / size + 0.5), 0), int(most * n))
        owed -= copies * size
        out.append(copies)
    return frame.assign(copies=out)[["source_key", "size", "copies"]]


def mix(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    ceiling: float = CEILING,
    salts: int = SALTS,
) -> DataFrame:
    """The kept columns and size, source_size, target and copies of each document.

    Copies of a source and size are counted exactly; which of its documents get the odd ones goes by a
    hash of key and text. Documents of one source and size are dealt into ``salts`` cells in which all, none or,
    in one cell of a source and size, some get an odd copy. Only the rows of those cells have to be ranked
    together; others stay in parts of the size of a task, so that rows without keys and equal rows are no single
    task.
    """
    draw = F.xxhash64(F.col(key), text_of(text), F.lit(7))
    rows = docs.select(
        *(F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)),
        F.col(source).alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("source_key"),
        n_words(text).alias("size"),
        draw.alias("draw"),
        F.pmod(F.shiftright(draw, 20), F.lit(salts)).cast("int").alias("salt"),
    )
    fine = saved(
        rows.groupBy("source_key", "size", "salt").agg(F.count(F.lit(1)).alias("n"), F.first("source").alias("source")), "sizes"
    )
    coarse = fine.groupBy("source_key", "size").agg(F.sum("n").alias("n_size"))
    totals = fine.groupBy("source_key").agg(
        F.first("source").alias("source"), F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n")
    )
    histogram = saved(coarse, "histogram")
    state = balance(histogram, targets(totals, weights, share, ceiling), ceiling)
    rated = histogram.join(state, "source_key").select(
        "source_key", "size", "n_size", _rate(ceiling).alias("rate"), F.lit(ceiling).alias("ceiling")
    )
    whole = rated.groupBy("source_key").applyInPandas(_copies, "source_key string, size long, copies long")
    per_size = whole.join(histogram, ["source_key", "size"]).join(
        state.select("source_key", "source_size", "target"), "source_key"
    )
    before = F.sum("n").over(W.partitionBy("source_key", "size").orderBy("salt")) - F.col("n")
    odd = F.col("copies") % F.col("n_size")
    plan = fine.drop("source").join(per_size, ["source_key", "size"]).select(
        "source_key", "size", "salt", "source_size", "target",
        F.floor(F.col("copies") / F.col("n_size")).alias("each"),
        (odd - before).alias("odd"),
        ((odd > before) & (odd - before < F.col("n"))).alias("some"),
    )
    ranked = W.partitionBy("source_key", "size", "salt", "part").orderBy("draw", *(F.col(f"kept_{i}") for i, c in enumerate(keep) if c == key))
    placed = rows.drop("source").join(saved(plan, "copies"), ["source_key", "size", "salt"])
    # Which part a row of a cell that gets all or none is in has no bearing on the result.
    placed = placed.withColumn("part", F.when(F.col("some"), -1).otherwise(F.spark_partition_id()))
    placed = placed.withColumn("rank", F.row_number().over(ranked))
    copies = F.col("each") + F.when(F.col("rank") <= F.col("odd"), 1).otherwise(0)
    return placed.select(
        *(F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)), "size", "source_size", "target", copies.alias("copies")
    )
