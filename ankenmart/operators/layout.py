"""Clustered layout of a written table."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a range, that is of a task and its file.
RANGE_ROWS = 300_000


def clustered(rows: DataFrame, key: str, *spread: str) -> DataFrame:
    """Range-partition and sort by ``key``, so that Parquet statistics prune on it.

    ``spread`` columns follow the key in the range; they let a key that owns a large
    part of the rows cover several files instead of one task.
    """
    return rows.repartitionByRange(key, *spread).sortWithinPartitions(key, *spread)


@dataclass(frozen=True)
class Ranges:
    """Ranges of a key, by the first key of each but the first range. A key that owns several is there as often."""

    starts: Sequence[str]

    @property
    def count(self) -> int:
        return len(self.starts) + 1

    def place(self, key: Column, slice_: Column) -> Column:
        """The number of the range; the slices of a key are dealt into the ranges that end with it."""
        last = self._before(key, equal=True)
        if len(set(self.starts)) == len(self.starts):
            return last
        return last - slice_ % (last - self._before(key, equal=False) + 1)

    def parts(self, most: int) -> list[tuple[Ranges, Callable[[Column], Column]]]:
        """These ranges about ``most`` at a time, each time with the condition of a key that is in them. The ranges
        of one key stay together; NULL is in the first."""
        cuts = sorted({bisect_left(self.starts, self.starts[i - 1]) for i in range(most, self.count, most)})
        firsts, ends = [0, *(c + 1 for c in cuts)], [*cuts, len(self.starts)]

        def own(lower: str | None, upper: str | None, key: Column) -> Column:
            above = F.lit(True) if lower is None else F.coalesce(key.cast("string") >= lower, F.lit(False))
            return above if upper is None else above & F.coalesce(key.cast("string") < upper, F.lit(True))

        bounds = [None, *(self.starts[c] for c in cuts), None]
        return [
            (Ranges(tuple(self.starts[a:b])), partial(own, lower, upper))
            for a, b, lower, upper in zip(firsts, ends, bounds, bounds[1:])
        ]

    def _before(self, key: Column, equal: bool) -> Column:
        """How many starts are below the key, or equal: steps of halving length. None are for a NULL key."""
        if not self.starts:
            return F.lit(0)
        starts = F.lit(list(self.starts))
        steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(self.starts).bit_length()))))
        begin = F.struct(key.alias("key"), F.lit(0).alias("at"))

        def step(state: Column, width: Column) -> Column:
            further = state["at"] + width
            start = F.get(starts, further - 1)
            below = start <= state["key"] if equal else start < state["key"]
            return F.struct(state["key"].alias("key"), F.when(below, further).otherwise(state["at"]).alias("at"))

        return F.aggregate(steps, begin, step, lambda state: state["at"])

    def dealt(self, rows: DataFrame, key: str, slice_: str, place: str) -> DataFrame:
        """The rows partitioned by their range, whose number is the column ``place``: tables dealt alike join on
        it, the key and the slice without another exchange."""
        # Never NULL, which Spark knows by the coalesce and so does not place each row twice to find out.
        number = F.coalesce(self.place(F.col(key), F.col(slice_)).cast("int"), F.lit(0))
        return rows.withColumn(place, number).repartitionById(self.count, F.col(place))


def ranges_of(counts: DataFrame, key: str, rows: str, held: int = RANGE_ROWS) -> Ranges:
    """Ranges of about ``held`` rows, from the number of ``rows`` of each key. Two starts a range, one string each,
    come to the driver."""
    total = counts.agg(F.sum(rows)).first()[0] or 0
    sorts = total // (64 * held) + 1
    ordered = counts.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(rows).alias("n"))

    def starts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = -1  # so that the first key of a task starts a range
        for frame in frames:
            ends = np.cumsum(frame["n"].to_numpy("i8")) + max(before, 0)
            begins = np.append(before, ends[:-1])
            times = ends // held - begins // held if len(frame) else ends
            yield pd.DataFrame({"key": np.repeat(frame["key"].to_numpy(), times)})
            before = ends[-1] if len(frame) else before

    found = ordered.repartitionByRange(sorts, "key").sortWithinPartitions("key").mapInPandas(starts, "key string").collect()
    return Ranges(tuple(sorted(r["key"] for r in found)[1:]))
