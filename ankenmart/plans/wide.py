"""The two wide tables and the building arrays per opportunity."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ankenmart.functions.arrays import distinct_array
from ankenmart.operators import colocated
from ankenmart.operators.fan_out import SLICE_ROWS, fan_out, hot_keys
from ankenmart.operators.layout import Ranges
from ankenmart.operators.lookup import lookup, role_column
from ankenmart.operators.parts import PART_ROWS, parts
from ankenmart.operators.projection import renamed
from ankenmart.plans.marts import BY_OPPORTUNITY, LINES, hot_opportunities
from ankenmart.session import shuffles_freed
from ankenmart.sources.wide_contract import LINE_ITEM_WIDE, OPPORTUNITY_WIDE, WideColumn

Tables = Mapping[str, DataFrame]

CALENDAR = "dim_date"

# Role -> (column of the rows, dimension, its key).
_SHARED_ROLES = {
    "account": ("account_id", "dim_account", "account_id"),
    "department": ("department_id", "dim_department", "department_id"),
    "record_type": ("record_type_id", "dim_record_type", "record_type_id"),
    "contract": ("contract_expectation_date", "dim_date", "date_key"),
}
OPPORTUNITY_ROLES = _SHARED_ROLES | {
    "user": ("user_id", "dim_user", "user_id"),
    "close": ("close_date_key", "dim_date", "date_key"),
}
HEADER_ROLES = _SHARED_ROLES | {
    "design": ("design_id", "dim_account", "account_id"),
    "building_owner": ("building_owner_id", "dim_account", "account_id"),
    "user": ("owner_id", "dim_user", "user_id"),
    "close": ("close_date", "dim_date", "date_key"),
}
LINE_ROLES = {
    "product": ("product_id", "dim_product", "product_id"),
    "service": ("service_date", "dim_date", "date_key"),
}


def _wanted(contract: Iterable[WideColumn], role: str) -> list[str]:
    return [c.column for c in contract if c.role == role]


def _grain(
    rows: DataFrame,
    name: str,
    keys: Collection[str],
    roles: Mapping[str, tuple[str, str, str]],
    tables: Tables,
    contract: Collection[WideColumn],
    calendar: bool = True,
) -> DataFrame:
    """The rows of one grain with their own wanted columns and those of their dimensions, maybe but the calendar."""
    used = {r: spec for r, spec in roles.items() if _wanted(contract, r)}
    own = dict.fromkeys([*keys, *_wanted(contract, name), *(on for on, _, _ in used.values())])
    rows = renamed(rows, [(c, c if c in keys else role_column(name, c)) for c in own])
    for role, (on, dimension, key) in used.items():
        if dimension == CALENDAR and not calendar:
            continue
        rows = lookup(
            rows,
            tables[dimension],
            on if on in keys else role_column(name, on),
            key,
            role,
            _wanted(contract, role),
            # One row a day between two known dates: the only dimension with a known size.
            bounded=dimension == CALENDAR,
        )
    return rows


def _labelled(rows: DataFrame, contract: Iterable[WideColumn], key: str) -> DataFrame:
    return renamed(
        rows, [(key if c.column == key else role_column(c.role, c.column), c.label) for c in contract]
    )


def _pick(contract: tuple[WideColumn, ...], labels: Collection[str] | None) -> tuple[WideColumn, ...]:
    if labels is None:
        return contract
    unknown = set(labels) - {c.label for c in contract}
    if unknown:
        raise ValueError(f"no wide column {', '.join(sorted(unknown))}")
    return tuple(c for c in contract if c.label in labels)


_PLACES = {"states": "address_state", "cities": "address_city", "streets": "address_street"}


def _building_links(tables: Tables) -> DataFrame:
    return lookup(
        tables["bridge_opportunity_building"].select("opportunity_id", "building_id"),
        tables["dim_building"],
        "building_id",
        "building_id",
        "building",
        _PLACES.values(),
    )


def _building_arrays(name: Callable[[str], str]) -> list[Column]:
    return [distinct_array(F.col(role_column("building", c))).alias(name(a)) for a, c in _PLACES.items()]


def buildings_by_opportunity(tables: Tables) -> DataFrame:
    """Distinct states, cities and streets of the buildings linked to an opportunity."""
    return _building_links(tables).groupBy("opportunity_id").agg(*_building_arrays(lambda a: f"building_{a}"))


def gold_opportunity_wide(tables: Tables, labels: Collection[str] | None = None) -> DataFrame:
    contract = _pick(OPPORTUNITY_WIDE, labels)
    rows = _grain(
        tables["fact_opportunity"], "header", ("opportunity_id",), OPPORTUNITY_ROLES, tables, contract
    )
    return _labelled(rows, contract, "opportunity_id")


def gold_opportunity_line_item_wide(
    tables: Tables, labels: Collection[str] | None = None, hot: DataFrame | None = None, ranges: Ranges | None = None
) -> DataFrame:
    """Header left join line, with the dimensions of each grain attached before the join.

    A left join on header columns commutes with the one to the lines, and one on line
    columns moves into their side, so the result is that of joining every dimension to
    the line-item fact. But eight of the lookups then run on the headers, a fraction of
    the rows, and the lines are shuffled once, on the opportunity.

    ``labels`` limits the columns and leaves out the lookups none of them needs. That
    relies on unique dimension keys, which the data tests check. ``ranges`` of the
    opportunities partition the result.
    """
    contract = _pick(LINE_ITEM_WIDE, labels)
    header, line = _line_item_grains(tables, contract, calendar=False)
    arrays = _wanted(contract, "buildings")
    per_key = []
    if arrays:
        per_key.append(
            renamed(
                buildings_by_opportunity(tables),
                [(_KEY, _KEY), *((a, role_column("buildings", a)) for a in arrays)],
            )
        )
    hot = hot_opportunities(tables) if hot is None else hot
    rows = fan_out(header, line, _KEY, role_column("line", "line_item_id"), hot, per_key, ranges)
    return _labelled(_with_calendar(rows, tables, contract), contract, _KEY)


_KEY = "opportunity_id"


def _line_item_grains(tables: Tables, contract: Collection[WideColumn], calendar: bool = True) -> tuple[DataFrame, DataFrame]:
    """Headers and lines with their dimensions, maybe but the calendar, of which they then have the dates."""
    header = _grain(tables["stg_opportunity"], "header", (_KEY,), HEADER_ROLES, tables, contract, calendar)
    line = _grain(
        tables["stg_opportunity_line_item"], "line", (_KEY, "line_item_id"), LINE_ROLES, tables, contract, calendar
    ).withColumnRenamed("line_item_id", role_column("line", "line_item_id"))
    return header, line


def _with_calendar(rows: DataFrame, tables: Tables, contract: Collection[WideColumn]) -> DataFrame:
    """The calendar columns of joined headers and lines. It is broadcast, so they come without a shuffle, and
    those of the join carry dates instead of them."""
    for grain, roles in (("header", HEADER_ROLES), ("line", LINE_ROLES)):
        for role, (on, dimension, key) in roles.items():
            if dimension == CALENDAR and (wanted := _wanted(contract, role)):
                rows = lookup(rows, tables[dimension], role_column(grain, on), key, role, wanted, bounded=True)
    return rows


def write_by_opportunity(
    tables: Tables,
    name: str,
    location: str,
    buckets: int | None = None,
    slice_rows: int = SLICE_ROWS,
    part_rows: int = PART_ROWS,
) -> str:
    """Headers, building links and lines, each with its dimensions, written once as the tables ``headers``,
    ``links`` and ``lines`` of a database, so that they join on the opportunity without an exchange. There are at least ``buckets``
    buckets, and more if their lines would not fit the memory of a task. Parts of about ``part_rows`` lines are written
    one after another: the broadcast list of hot opportunities is that of one part."""
    spark = tables[LINES].sparkSession
    buckets = max(buckets or 1, colocated.buckets_for(tables[LINES]))
    where = colocated.database(spark, name, location)
    spread = role_column("line", "line_item_id")
    with shuffles_freed(spark):
        for i, part in enumerate(parts(tables, BY_OPPORTUNITY, LINES, part_rows)):
            header, line = _line_item_grains(part, LINE_ITEM_WIDE)
            hot = hot_keys(part[LINES], _KEY, slice_rows)
            links = _building_links(part).drop("building_id")
            for table, rows in (("headers", header), ("links", links)):
                colocated.write_copied(rows, hot, _KEY, f"`{where}`.{table}", f"{location}/{table}", buckets, more=i > 0)
            colocated.write_many(line, hot, _KEY, spread, f"`{where}`.lines", f"{location}/lines", buckets, more=i > 0)
    return where


def line_item_wide_by_opportunity(spark: SparkSession, name: str) -> DataFrame:
    """``gold_opportunity_line_item_wide`` from the tables ``write_by_opportunity`` left."""
    header, links, line = (spark.table(f"`{name}`.{table}") for table in ("headers", "links", "lines"))
    arrays = colocated.by_key(links, _KEY, *_building_arrays(lambda a: role_column("buildings", f"building_{a}")))
    return _labelled(colocated.join(header, line, _KEY, [arrays]), LINE_ITEM_WIDE, _KEY)
