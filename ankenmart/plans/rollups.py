"""Stored rollups of a semantic model whose metrics, exact distinct counts included, merge to coarser dimensions.

A rollup has a row for each combination of its dimensions and each block of 32,768 dense ids of the counted column.
The row holds sums and counts, which add up, and for a distinct count the bitmap of the ids seen in the block, which
or together. So any subset of the dimensions, and any filter on them, is answered from the rollup as from the lines.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ankenmart.operators.numbering import dense_ids
from ankenmart.plans.semantic import AVG, COUNT, COUNT_DISTINCT, SUM, Metric, SemanticModel
from ankenmart.session import scratch_path, shuffles_freed
from ankenmart.storage import delete

_BLOCK, _BIT = "_block", "_bit"


@dataclass(frozen=True)
class Rollup:
    dimensions: tuple[str, ...]
    path: str
    rows: int


def _names(model: SemanticModel, phrases: Sequence[str]) -> tuple[str, ...]:
    return tuple(dict.fromkeys(model.dimension(p).name for p in phrases))


def _states(metric: Metric) -> dict[str, tuple[Column, Column]]:
    """Columns of a metric in a rollup: over the lines, and over rows of a rollup in one block."""
    value, n, total = metric.value(), f"{metric.name}_n", f"{metric.name}_sum"
    count, added = F.count(value), F.coalesce(F.sum(f"`{n}`"), F.lit(0))
    summed = (F.sum(value), F.sum(f"`{total}`"))
    if metric.kind == COUNT:
        return {n: (count, added)}
    if metric.kind == SUM:
        return {total: summed}
    if metric.kind == AVG:
        return {total: summed, n: (count, added)}
    if metric.kind == COUNT_DISTINCT:
        bits = f"{metric.name}_bits"
        seen = F.col(_BIT) if metric.flag is None else F.when(F.col(f"`{metric.flag}`"), F.col(_BIT))
        return {bits: (F.bitmap_construct_agg(seen), F.bitmap_or_agg(F.col(f"`{bits}`")))}
    raise ValueError(f"unknown aggregate {metric.kind}")


def _final(metric: Metric) -> Column:
    n, total = F.sum(f"`{metric.name}_n`"), F.sum(f"`{metric.name}_sum`")
    if metric.kind == COUNT:
        return F.coalesce(n, F.lit(0))
    if metric.kind == COUNT_DISTINCT:
        return F.coalesce(F.sum(F.bitmap_count(F.col(f"`{metric.name}_bits`"))), F.lit(0))
    return total if metric.kind == SUM else total.cast("double") / n


def write_rollups(
    model: SemanticModel, rows: DataFrame | Sequence[DataFrame], sets: Sequence[Sequence[str]], place: str, near: Sequence[str] = ()
) -> list[Rollup]:
    """A rollup of all metrics for each set of dimensions, below ``place``. The lines are made once, those of several
    DataFrames one after another, and, cut to the columns in use, written with their numbers; each set that no earlier
    rollup covers reads them from there, the others come from the smallest rollup that does. What is written on the
    way is deleted when it has been read, and so are shuffle files.

    ``near`` dimensions order the ids, so that the opportunities of one of their values are in few blocks.
    """
    counted = {m.column for m in model.metrics if m.kind == COUNT_DISTINCT}
    if len(counted) != 1:
        raise ValueError(f"{model.name} must count distinct values of one column, not of {sorted(counted)}")
    (column,) = counted
    used = model.columns_for([m.name for m in model.metrics], [*near, *(d for s in sets for d in s)])
    given = [rows] if isinstance(rows, DataFrame) else list(rows)
    spark = given[0].sparkSession
    lines_at, numbered_at = scratch_path(spark, "lines"), scratch_path(spark, "numbered")
    with shuffles_freed(spark):
        lines = _kept([part.select(*[f"`{c}`" for c in part.columns if c in used]) for part in given], lines_at)
        ids = dense_ids(lines, column, [model.dimension(d).column for d in near])
        numbered = lines.join(ids, F.col(f"`{column}`") == F.col("value"), "left").drop("value")
        numbered = numbered.withColumns({_BLOCK: F.bitmap_bucket_number("id"), _BIT: F.bitmap_bit_position("id")})
        still = model.columns_for([m.name for m in model.metrics if m.kind != COUNT_DISTINCT], [d for s in sets for d in s])
        numbered = _kept([numbered.drop("id", *({column} - still))], numbered_at)
        delete(spark, lines_at)
        made: list[Rollup] = []
        for i, names in sorted(enumerate(_names(model, s) for s in sets), key=lambda x: -len(x[1])):
            path = f"{place}/rollup_{i}"
            if covering := [r for r in made if set(names) <= set(r.dimensions)]:
                least = min(covering, key=lambda r: r.rows)
                grouped = _merged(spark.read.parquet(least.path), names, model.metrics)
            else:
                keys = [F.col(f"`{model.dimension(d).column}`").alias(d) for d in names]
                grouped = numbered.groupBy(*keys, _BLOCK).agg(
                    *[over.alias(c) for m in model.metrics for c, (over, _) in _states(m).items()]
                )
            grouped.write.mode("overwrite").option("compression", "zstd").parquet(path)
            made.append(Rollup(names, path, spark.read.parquet(path).count()))
        delete(spark, numbered_at)
    return made


def _kept(parts: Sequence[DataFrame], path: str) -> DataFrame:
    """The rows from a folder: several jobs read them, one a part makes them."""
    for rows in parts:
        rows.write.mode("append").option("compression", "zstd").parquet(path)
    return parts[0].sparkSession.read.schema(parts[0].schema).parquet(path)


def _merged(rollup: DataFrame, names: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """Rows of one combination and block as one."""
    states = [over.alias(c) for m in metrics for c, (_, over) in _states(m).items()]
    return rollup.groupBy(*[f"`{d}`" for d in names], _BLOCK).agg(*states)


def smallest(rollups: Sequence[Rollup], names: Sequence[str]) -> Rollup:
    """The rollup with the fewest rows that has all these dimensions."""
    covering = [r for r in rollups if set(names) <= set(r.dimensions)]
    if not covering:
        raise ValueError(f"no rollup has {', '.join(names)}")
    return min(covering, key=lambda r: r.rows)


def query(
    spark: SparkSession,
    model: SemanticModel,
    rollups: Sequence[Rollup],
    metrics: Sequence[str],
    dimensions: Sequence[str] = (),
    where: Mapping[str, Any] | None = None,
    order_by: Sequence[str] = (),
    limit: int | None = None,
) -> DataFrame:
    """What ``model.query`` gives over the lines, from the smallest rollup that covers the question."""
    by, picked = _names(model, dimensions), [model.metric(m) for m in metrics]
    rows = spark.read.parquet(smallest(rollups, [*by, *_names(model, list(where or {}))]).path)
    rows = model.filtered(rows, where, physical=False)
    merged = _merged(rows, by, picked)
    types = {f.name: f.dataType for f in rows.schema}

    def value(metric: Metric) -> Column:
        final, of = _final(metric), types.get(f"{metric.name}_sum")
        wide = metric.kind == SUM and isinstance(of, T.DecimalType)
        return (final.cast(T.DecimalType(38, of.scale)) if wide else final).alias(metric.name)

    return model.ordered(merged.groupBy(*[f"`{d}`" for d in by]).agg(*map(value, picked)), order_by, limit)
