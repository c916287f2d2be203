"""Staging: one cleaned, renamed, typed DataFrame per raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ankenmart.functions.casts import STAGING_CASTS
from ankenmart.operators.projection import ident
from ankenmart.sources.raw import RAW_TABLES, RawTable, Source

STAGING = {t.staged: t for t in RAW_TABLES.values()}


def _expressions(table: RawTable) -> list[str]:
    return [
        f"{STAGING_CASTS.get(c.cast, '{}').format(ident(c.name))} AS {ident(c.staged)}" for c in table.columns if c.staged
    ]


def stage(rows: DataFrame, table: RawTable) -> DataFrame:
    if table.keep is not None:
        flag, value = table.keep
        # A NULL flag drops the row; a plain equality also reaches the Parquet scan.
        rows = rows.where(F.col(flag) == F.lit(value))
    return rows.selectExpr(*_expressions(table))


def staging_sql(table: RawTable, relation: str) -> str:
    """The same as a query over a relation that any session can name."""
    kept = "" if table.keep is None else f" WHERE {ident(table.keep[0])} = {str(table.keep[1]).lower()}"
    return f"SELECT {', '.join(_expressions(table))} FROM {relation}{kept}"


def staged(source: Source, model: str) -> DataFrame:
    table = STAGING[model]
    return stage(source(table.name), table)


def staging_layer(source: Source) -> dict[str, DataFrame]:
    return {model: staged(source, model) for model in STAGING}
