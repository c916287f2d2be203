"""Projections given as names, sent to Spark as one list of SQL expressions.

Tables here have up to 89 columns. One call a projection, instead of several a column,
keeps the time to set up a plan short.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def ident(name: str) -> str:
    """The name as an SQL identifier; any letters and signs are allowed in it."""
    return "`" + name.replace("`", "``") + "`"


def renamed(rows: DataFrame, pairs: Iterable[tuple[str, str]], *more: str) -> DataFrame:
    """Columns under new names, in order; ``more`` are further expressions."""
    return rows.selectExpr(*[f"{ident(old)} AS {ident(new)}" for old, new in pairs], *more)
