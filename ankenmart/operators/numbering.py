"""Dense numbers for the distinct values of a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ankenmart.session import scratch_path


def dense_ids(rows: DataFrame, column: str, near: Sequence[str] = ()) -> DataFrame:
    """``value`` and ``id``, from 0 on without gaps; no id for NULL.

    Values whose smallest ``near`` columns are alike get numbers near each other. The values are sorted once and
    written; the driver sees the number of values of each partition of that sort, no value.
    """
    own = rows.where(F.col(f"`{column}`").isNotNull()).groupBy(F.col(f"`{column}`").alias("value"))
    firsts = [F.min(f"`{c}`").alias(f"near_{i}") for i, c in enumerate(near)]
    values = own.agg(*firsts) if firsts else own.agg(F.lit(0).alias("near_0"))
    path = scratch_path(rows.sparkSession, "numbers")
    ordered = values.orderBy(*[c for c in values.columns if c != "value"], "value")
    ordered.select("value", F.monotonically_increasing_id().alias("at")).write.parquet(path)
    placed = rows.sparkSession.read.parquet(path)
    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    starts, total = [], 0
    for size in sizes:
        starts.append((size.part, total))
        total += size.n
    first = rows.sparkSession.createDataFrame(starts, "part long, first long")
    # One row a partition of the sort.
    numbered = placed.join(F.broadcast(first), part == F.col("part"))
    return numbered.select("value", (F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("id"))
