"""N:1 left join that brings named attributes of a dimension to the rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ankenmart.operators.projection import renamed


def role_column(role: str, column: str) -> str:
    """Name of a dimension column once it is attached under a role."""
    return f"{role}__{column}"


def lookup(
    rows: DataFrame,
    dimension: DataFrame,
    on: str,
    key: str,
    role: str,
    attributes: Iterable[str],
    bounded: bool = False,
) -> DataFrame:
    """Left join ``rows.on = dimension.key``; attributes arrive as ``role__attribute``.

    The dimension is cut to the key and the attributes first, so that its size, as
    Spark measures it, decides between broadcast and sort-merge. ``bounded`` is for a
    dimension whose row count is known beforehand (the calendar) and only there asks
    for a broadcast. In a sort-merge the rows are the left side of a left join, the
    side AQE may split, so a hot or NULL key does not end in one task.
    """
    joined_key = role_column(role, "key")
    side = renamed(dimension, [(key, joined_key), *((a, role_column(role, a)) for a in attributes)])
    if bounded:
        side = F.broadcast(side)
    return rows.join(side, F.col(on) == F.col(joined_key), "left").drop(joined_key)
