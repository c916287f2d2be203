"""Arrays of distinct values, and their JSON text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct_array(value: Column) -> Column:
    """Aggregate: sorted distinct non-NULL values, an empty array if there are none."""
    return F.array_sort(F.collect_set(value))


def array_from_json(text: Column) -> Column:
    return F.from_json(text, "array<string>")


def array_to_json(values: Column) -> Column:
    return F.to_json(values)
