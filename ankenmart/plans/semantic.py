"""Metric layer: named metrics by named dimensions, as one aggregation.

A model maps logical names (and their synonyms) to columns of a wide table. A query
picks names; it becomes ``select``, ``groupBy`` and ``agg`` on a DataFrame.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COUNT, COUNT_DISTINCT, SUM, AVG = "count", "count_distinct", "sum", "avg"


@dataclass(frozen=True)
class Member:
    """A fact or a dimension: a logical name over a physical column."""

    name: str
    column: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Metric:
    """An aggregate of one column, over the rows where the flag column is true if given."""

    name: str
    kind: str
    column: str
    flag: str | None = None

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.column,) if self.flag is None else (self.column, self.flag)

    def value(self) -> Column:
        # No ELSE: a NULL or false flag gives NULL, which no aggregate counts.
        value = F.col(self.column)
        return value if self.flag is None else F.when(F.col(self.flag), value)


@dataclass(frozen=True)
class SemanticModel:
    name: str
    key: str
    synonyms: tuple[str, ...]
    facts: tuple[Member, ...]
    dimensions: tuple[Member, ...]
    metrics: tuple[Metric, ...]
    _index: dict[str, dict[str, list[Any]]] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        index: dict[str, dict[str, list[Any]]] = {}
        for kind in ("facts", "dimensions", "metrics"):
            names: dict[str, list[Any]] = {}
            for member in getattr(self, kind):
                for phrase in (member.name, *getattr(member, "synonyms", ())):
                    names.setdefault(phrase, []).append(member)
            index[kind] = names
        object.__setattr__(self, "_index", index)

    def answers_to(self, phrase: str) -> bool:
        """Whether the phrase names the table of this model."""
        return phrase == self.name or phrase in self.synonyms

    def _find(self, kind: str, phrase: str) -> Any:
        found = self._index[kind].get(phrase, [])
        exact = [m for m in found if m.name == phrase]
        if len(exact or found) != 1:
            trouble = "ambiguous" if found else "unknown"
            raise ValueError(f"{trouble} name {phrase!r} among the {kind} of {self.name}")
        return (exact or found)[0]

    def dimension(self, phrase: str) -> Member:
        return self._find("dimensions", phrase)

    def fact(self, phrase: str) -> Member:
        return self._find("facts", phrase)

    def metric(self, phrase: str) -> Metric:
        return self._find("metrics", phrase)

    def columns_for(
        self,
        metrics: Iterable[str] = (),
        dimensions: Iterable[str] = (),
        facts: Iterable[str] = (),
        where: Mapping[str, Any] | None = None,
    ) -> set[str]:
        """Physical columns a query needs, e.g. to build no more of the wide table."""
        needed = {self.dimension(d).column for d in (*dimensions, *(where or {}))}
        needed |= {self.fact(f).column for f in facts}
        for m in metrics:
            needed.update(self.metric(m).columns)
        return needed

    def query(
        self,
        rows: DataFrame,
        metrics: Sequence[str] = (),
        dimensions: Sequence[str] = (),
        facts: Sequence[str] = (),
        where: Mapping[str, Any] | None = None,
        order_by: Sequence[str] = (),
        limit: int | None = None,
    ) -> DataFrame:
        """Metrics by dimensions, or, with ``facts``, one row for each row of the table.

        ``where`` maps a dimension to a value or a list of values. ``order_by`` names
        output columns, with a leading ``-`` for largest first; NULL ranks highest.
        """
        if facts and metrics:
            raise ValueError("facts are row values and cannot be mixed with metrics")
        if not (facts or metrics or dimensions):
            raise ValueError("nothing to query")
        rows = self.filtered(rows, where)
        by = [self.dimension(d) for d in dimensions]
        if facts:
            picked = [*by, *(self.fact(f) for f in facts)]
            out = rows.select(*[F.col(_quoted(m.column)).alias(m.name) for m in picked])
        else:
            out = _aggregate(rows, by, [self.metric(m) for m in metrics])
        return self.ordered(out, order_by, limit)

    def filtered(self, rows: DataFrame, where: Mapping[str, Any] | None, physical: bool = True) -> DataFrame:
        """The rows that match; their dimensions have physical or logical names."""
        for phrase, wanted in (where or {}).items():
            dimension = self.dimension(phrase)
            rows = rows.where(_matches(F.col(_quoted(dimension.column if physical else dimension.name)), wanted))
        return rows

    def ordered(self, rows: DataFrame, order_by: Sequence[str], limit: int | None) -> DataFrame:
        if order_by:
            rows = rows.orderBy(*[self._sort(phrase) for phrase in order_by])
        return rows if limit is None else rows.limit(limit)

    def _sort(self, phrase: str) -> Column:
        largest_first = phrase.startswith("-")
        phrase = phrase.removeprefix("-")
        for kind in ("metrics", "dimensions", "facts"):
            if phrase in self._index[kind]:
                phrase = self._find(kind, phrase).name
                break
        column = F.col(_quoted(phrase))
        return column.desc_nulls_first() if largest_first else column.asc_nulls_last()


def _quoted(name: str) -> str:
    return f"`{name}`"


def _matches(column: Column, wanted: Any) -> Column:
    if wanted is None:
        return column.isNull()
    if isinstance(wanted, (list, tuple, set, frozenset)):
        values = [v for v in wanted if v is not None]
        return column.isin(*values) | column.isNull() if len(values) < len(wanted) else column.isin(*values)
    return column == F.lit(wanted)


def _aggregate(rows: DataFrame, by: list[Member], metrics: list[Metric]) -> DataFrame:
    """Group by the dimensions; a NULL dimension value is a group of its own.

    A distinct count groups by (dimensions, counted column) first. Each value is then
    one row a group, distinct counts become plain ones, and several of them share the
    step instead of multiplying the rows. It also spreads a group that owns a large
    part of the rows over many tasks, while the map side has combined them already.
    """
    inputs = {c: f"_in{i}" for i, c in enumerate(dict.fromkeys(c for m in metrics for c in m.columns))}
    rows = rows.select(
        *[F.col(_quoted(d.column)).alias(d.name) for d in by],
        *[F.col(_quoted(c)).alias(alias) for c, alias in inputs.items()],
    )
    metrics = [Metric(m.name, m.kind, inputs[m.column], m.flag and inputs[m.flag]) for m in metrics]
    keys = [_quoted(d.name) for d in by]
    if not metrics:
        return rows.select(*keys).distinct()
    counted = {m.column for m in metrics if m.kind == COUNT_DISTINCT}
    if len(counted) == 1:
        steps = [_two_steps(m, rows.schema) for m in metrics]
        parts = [part for first, _ in steps for part in first]
        grouped = rows.groupBy(*keys, *counted).agg(*parts)
        return grouped.groupBy(*keys).agg(*[final.alias(m.name) for m, (_, final) in zip(metrics, steps)])
    return rows.groupBy(*keys).agg(*[_one_step(m, rows.schema).alias(m.name) for m in metrics])


def _widest(total: Column, of: T.DataType) -> Column:
    return total.cast(T.DecimalType(38, of.scale)) if isinstance(of, T.DecimalType) else total


def _one_step(metric: Metric, schema: T.StructType) -> Column:
    value = metric.value()
    if metric.kind == COUNT:
        return F.count(value)
    if metric.kind == COUNT_DISTINCT:
        return F.count_distinct(value)
    if metric.kind == SUM:
        return _widest(F.sum(value), schema[metric.column].dataType)
    if metric.kind == AVG:
        return F.sum(value).cast("double") / F.count(value)
    raise ValueError(f"unknown aggregate {metric.kind}")


def _two_steps(metric: Metric, schema: T.StructType) -> tuple[list[Column], Column]:
    """Partial aggregates per counted value, and the aggregate of those."""
    value, part, n = metric.value(), f"{metric.name}_part", f"{metric.name}_n"
    total, count = F.sum(_quoted(part)), F.coalesce(F.sum(_quoted(n)), F.lit(0))
    if metric.kind == COUNT:
        return [F.count(value).alias(n)], count
    if metric.kind == COUNT_DISTINCT:
        # 1 if any row of this value counts; NULL values were never counted.
        return [F.max(F.when(value.isNotNull(), F.lit(1))).alias(n)], count
    if metric.kind == SUM:
        return [F.sum(value).alias(part)], _widest(total, schema[metric.column].dataType)
    if metric.kind == AVG:
        # 0 rows: the sum is NULL, and so is the mean.
        return [F.sum(value).alias(part), F.count(value).alias(n)], total.cast("double") / F.sum(_quoted(n))
    raise ValueError(f"unknown aggregate {metric.kind}")
