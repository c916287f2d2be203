"""1:N left join that stays balanced when one key owns a large part of the N side.

``one LEFT JOIN many`` cannot be split by AQE where ``many`` is skewed, because each
part would emit its own unmatched rows. Here the rows of a hot key are dealt into
slices, the single row of that key is copied once per slice, and both sides join on
(key, slice). Keys that are not hot have slice 0 only and join as usual.

A key is hot above ``slice_rows`` rows, so at most ``rows / slice_rows`` keys are hot:
that is the size bound of the broadcast list, and the number of extra copies is bounded
the same way. Counting reads the key column only and combines before its shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ankenmart.operators.layout import Ranges

SLICE_ROWS = 1_000_000

SLICE, SLICES, MATCHED = "_slice", "_slices", "_matched"
_HOT_KEY, _MANY_KEY, _RANGE = "_hot_key", "_many_key", "_range"


def hot_keys(many: DataFrame, key: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Keys with more than ``slice_rows`` rows and the number of slices for each.

    ``many`` may be the bare table, before any N:1 lookup that keeps its rows.
    """
    counts = many.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return hot_counts(counts, key, "n", slice_rows)


def hot_counts(counts: DataFrame, key: str, n: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The same from the number of rows of each key."""
    slices = F.ceil(F.col(n) / slice_rows).cast("int").alias(SLICES)
    return counts.where(F.col(n) > slice_rows).select(F.col(key).alias(_HOT_KEY), slices)


def _with_slices(rows: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    return rows.join(F.broadcast(hot), F.col(key) == F.col(_HOT_KEY), "left").drop(_HOT_KEY)


def _deal(many: DataFrame, hot: DataFrame, key: str, spread_by: Column) -> DataFrame:
    """Each row goes to exactly one slice, the same one if the task runs again."""
    return (
        _with_slices(many, hot, key)
        .withColumn(SLICE, F.coalesce(F.pmod(F.xxhash64(spread_by), F.col(SLICES)).cast("int"), F.lit(0)))
        .drop(SLICES)
    )


def _copy(one: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """One copy per slice of the key; ``_slices`` stays NULL for keys that are not hot."""
    last = F.coalesce(F.col(SLICES) - 1, F.lit(0))
    return _with_slices(one, hot, key).withColumn(SLICE, F.explode(F.sequence(F.lit(0), last)))


def fan_out(
    one: DataFrame,
    many: DataFrame,
    key: str,
    spread_by: str,
    hot: DataFrame,
    per_key: Iterable[DataFrame] = (),
    ranges: Ranges | None = None,
) -> DataFrame:
    """``one LEFT JOIN per_key... LEFT JOIN many`` on ``key``, which all sides name alike.

    ``hot`` is ``hot_keys`` of ``many``. ``per_key`` tables have one row a key. They are
    copied per slice like ``one``, so that the wide ``one`` side is shuffled once for
    all the joins. With ``ranges`` of the key the result is partitioned by them, by the
    very shuffles of the join.
    """

    def placed(rows: DataFrame) -> DataFrame:
        return rows if ranges is None else ranges.dealt(rows, key, SLICE, _RANGE)

    on = [key, SLICE] if ranges is None else [key, SLICE, _RANGE]

    def beside(rows: DataFrame, side: DataFrame, name: str) -> DataFrame:
        names = {c: f"{name}_{i}" for i, c in enumerate(on)}
        same = reduce(and_, (F.col(c) == F.col(other) for c, other in names.items()))
        return rows.join(side.withColumnsRenamed(names), same, "left").drop(*names.values())

    rows = placed(_copy(one, hot, key))
    for i, table in enumerate(per_key):
        rows = beside(rows, placed(_copy(table, hot, key).drop(SLICES)), f"_beside_{i}")
    dealt = _deal(many, hot, key, F.col(spread_by)).withColumn(MATCHED, F.lit(True))
    joined = beside(rows, placed(dealt), _MANY_KEY)
    # A hot key has rows by definition, so a copy whose slice got none is no result row.
    return joined.where(F.col(SLICES).isNull() | F.col(MATCHED)).drop(*on[1:], SLICES, MATCHED)
