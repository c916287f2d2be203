"""DuckDB SQL for the same results, over the driver's tables.

Each model is a CTE. The wide tables are written as every dimension joined to the fact,
while the Spark side attaches header dimensions before the join to the lines.
"""

from __future__ import annotations

import re

from ankenmart.plans.marts import DIM_ASSET, FACT_OPPORTUNITY, LINE_FACT_DETAIL, LINE_FACT_HEADER
from ankenmart.plans.quality import KEYS
from ankenmart.plans.staging import STAGING
from ankenmart.sources.raw import RAW_TABLES
from ankenmart.sources.wide_contract import LINE_ITEM_WIDE, OPPORTUNITY_WIDE
from fixtures.crm import MAPPING

AS_OF = "2026-07-31"
LAST_DAY = "2031-07-31"


def _quoted(name: str) -> str:
    return '"' + name + '"'


def _staging_sql(model: str) -> str:
    table = STAGING[model]
    casts = {None: "{}", "int": "cast(round({}) AS int)", "money": "cast({} AS decimal(18,2))"}
    columns = ", ".join(f"{casts[c.cast].format(c.name)} AS {c.staged}" for c in table.columns if c.staged)
    where = f" WHERE {table.keep[0]} = {str(table.keep[1]).lower()}" if table.keep else ""
    return f"SELECT {columns} FROM ({MAPPING[table.name]}){where}"


def _select_sql(columns: str, alias: str = "") -> str:
    lines = [line.split() for line in columns.split("\n") if line.strip()]
    return ", ".join(f"{alias}{words[0]} AS {words[-1]}" for words in lines)


_DATES = f"""
SELECT d AS date_key, year(d) AS year, month(d) AS month, day(d) AS day,
  year(d) - CASE WHEN month(d) < 4 THEN 1 ELSE 0 END AS fiscal_year,
  CASE WHEN month(d) < 4 THEN 4 WHEN month(d) < 7 THEN 1 WHEN month(d) < 10 THEN 2 ELSE 3 END AS quarter,
  dayofweek(d) AS day_of_week, dayname(d) AS day_name, monthname(d) AS month_name,
  strftime(d, '%Y-%m') AS year_month,
  concat(year(d) - CASE WHEN month(d) < 4 THEN 1 ELSE 0 END, '-Q',
    CASE WHEN month(d) < 4 THEN 4 WHEN month(d) < 7 THEN 1 WHEN month(d) < 10 THEN 2 ELSE 3 END) AS year_quarter,
  dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT cast(s AS date) AS d FROM generate_series(DATE '2020-01-01', DATE '{LAST_DAY}', INTERVAL 1 DAY) g(s))
"""


def _array(column: str) -> str:
    return f"list_sort(coalesce(list(DISTINCT {column}) FILTER (WHERE {column} IS NOT NULL), []))"


_BUILDINGS = f"""
SELECT b.opportunity_id, {_array("d.address_state")} AS building_states,
  {_array("d.address_city")} AS building_cities, {_array("d.address_street")} AS building_streets
FROM bridge_opportunity_building b LEFT JOIN dim_building d ON b.building_id = d.building_id
GROUP BY b.opportunity_id
"""

# Fact column that carries a wide column under another name.
_FACT_NAMES = {
    "bpr_estimated_amount": "ml_amount",
    "created_date": "line_item_created_date",
    "last_modified_date": "line_item_last_modified_date",
}


def _wide_sql(contract, fact: str, joins: list[str], line_names: dict[str, str]) -> str:
    def source(c) -> str:
        if c.role == "line":
            return f"f.{line_names.get(c.column, c.column)}"
        return f"f.{c.column}" if c.role == "header" else f"{c.role}.{c.column}"

    columns = ", ".join(f"{source(c)} AS {_quoted(c.label)}" for c in contract)
    return f"SELECT {columns} FROM {fact} f " + " ".join(f"LEFT JOIN {j}" for j in joins)


MODELS: dict[str, str] = {model: _staging_sql(model) for model in STAGING} | {
    "dim_account": "SELECT * EXCLUDE (record_type_id) FROM stg_account",
    "dim_asset": f"SELECT {_select_sql(DIM_ASSET)} FROM stg_asset",
    "dim_building": "SELECT * FROM stg_building",
    "dim_department": "SELECT * FROM stg_department",
    "dim_product": "SELECT * FROM stg_product",
    "dim_record_type": "SELECT * FROM stg_record_type",
    "dim_user": "SELECT * FROM stg_user",
    "dim_date": _DATES,
    "bridge_opportunity_asset": "SELECT * EXCLUDE (name) FROM stg_opportunity_asset",
    "bridge_opportunity_building": "SELECT * EXCLUDE (name) FROM stg_opportunity_building",
    "fact_opportunity": f"SELECT {_select_sql(FACT_OPPORTUNITY)} FROM stg_opportunity",
    "fact_opportunity_line_item": (
        f"SELECT h.opportunity_id, d.line_item_id, {_select_sql(LINE_FACT_HEADER, 'h.')}, "
        f"{_select_sql(LINE_FACT_DETAIL, 'd.')} "
        "FROM stg_opportunity h LEFT JOIN stg_opportunity_line_item d ON h.opportunity_id = d.opportunity_id"
    ),
    "buildings_by_opportunity": _BUILDINGS,
    "gold_opportunity_wide": _wide_sql(
        OPPORTUNITY_WIDE,
        "fact_opportunity",
        [
            "dim_account account ON f.account_id = account.account_id",
            'dim_user "user" ON f.user_id = "user".user_id',
            "dim_department department ON f.department_id = department.department_id",
            "dim_record_type record_type ON f.record_type_id = record_type.record_type_id",
            'dim_date "close" ON f.close_date_key = "close".date_key',
            "dim_date contract ON f.contract_expectation_date = contract.date_key",
        ],
        {},
    ),
    "gold_opportunity_line_item_wide": _wide_sql(
        LINE_ITEM_WIDE,
        "fact_opportunity_line_item",
        [
            "dim_account account ON f.account_id = account.account_id",
            "dim_account design ON f.design_id = design.account_id",
            "dim_account building_owner ON f.building_owner_id = building_owner.account_id",
            "buildings_by_opportunity buildings ON f.opportunity_id = buildings.opportunity_id",
            "dim_product product ON f.product_id = product.product_id",
            'dim_user "user" ON f.owner_id = "user".user_id',
            "dim_department department ON f.department_id = department.department_id",
            "dim_record_type record_type ON f.record_type_id = record_type.record_type_id",
            'dim_date "close" ON f.close_date = "close".date_key',
            "dim_date contract ON f.contract_expectation_date = contract.date_key",
            "dim_date service ON f.service_date = service.date_key",
        ],
        _FACT_NAMES,
    ),
}
for _name in ("gold_opportunity_wide", "gold_opportunity_line_item_wide"):
    MODELS[_name] = re.sub(r"(?<![\w\"])(user|close)\.", r'"\1".', MODELS[_name])

LINE_WIDE = "gold_opportunity_line_item_wide"


def with_models(sql: str) -> str:
    """The query below the CTEs of all models it needs."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for model in MODELS:
            if model not in needed and re.search(rf"\b{model}\b", text):
                needed.add(model)
                todo.append(MODELS[model])
    if not needed:
        return sql
    ctes = ",\n".join(f"{m} AS ({sql_})" for m, sql_ in MODELS.items() if m in needed)
    return f"WITH {ctes}\n{sql}"


def model(name: str) -> str:
    return with_models(f"SELECT * FROM {name}")


# One SQL aggregate per metric; sums of money keep two decimals.
METRICS: dict[str, str] = {
    "品目件数": 'count("品目ID")',
    "案件数": 'count(DISTINCT "案件ID")',
    "合計金額合計": 'cast(sum("合計金額") AS decimal(38,2))',
    "見積金額合計": 'cast(sum("見積金額") AS decimal(38,2))',
    "提示金額合計": 'cast(sum("提示金額") AS decimal(38,2))',
    "利益合計": 'cast(sum("利益") AS decimal(38,2))',
    "台数合計": 'cast(sum("台数") AS bigint)',
    "平均利益率": 'cast(sum("利益率") AS double) / count("利益率")',
    "受注案件数": 'count(DISTINCT CASE WHEN "受注済み" THEN "案件ID" END)',
    "受注金額合計": 'cast(sum(CASE WHEN "受注済み" THEN "合計金額" END) AS decimal(38,2))',
}


def metrics(names: list[str], by: dict[str, str] | None = None, where: str = "") -> str:
    """Metrics by dimensions, given as logical name and wide column."""
    keys = [f"{_quoted(column)} AS {_quoted(name)}" for name, column in (by or {}).items()]
    picked = [f"{METRICS[n]} AS {_quoted(n)}" for n in names]
    group = " GROUP BY " + ", ".join(_quoted(c) for c in by.values()) if by else ""
    return with_models(f"SELECT {', '.join(keys + picked)} FROM {LINE_WIDE}{where}{group}")


def not_null_failures() -> str:
    return with_models(
        "\nUNION ALL ".join(
            f"SELECT '{m}' AS model, '{c}' AS \"column\", 'not_null' AS test, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {m}"
            for m, c in KEYS.items()
        )
    )


def unique_failures() -> str:
    return with_models(
        "\nUNION ALL ".join(
            f"SELECT '{m}' AS model, '{c}' AS \"column\", 'unique' AS test, count(*) AS failures FROM "
            f"(SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
            for m, c in KEYS.items()
        )
    )


def row_counts(*names: str) -> str:
    names = names or tuple(m for m in MODELS if m != "buildings_by_opportunity")
    return with_models(
        "\nUNION ALL ".join(f"SELECT '{m}' AS model, count(*) AS row_count FROM {m}" for m in names)
    )


def held_back(failed: tuple[str, ...], blocked: tuple[str, ...], one_more: str) -> str:
    """Status and rows of each model; a mart that is not published has none, one staging model has one row more."""

    def one(model: str) -> str:
        status = "failed" if model in failed else "blocked" if model in blocked else "built"
        n = "NULL" if status != "built" and model not in STAGING else "count(*) + 1" if model == one_more else "count(*)"
        return f"(SELECT '{model}' AS model, '{status}' AS status, cast({n} AS bigint) AS row_count FROM {model}{' LIMIT 1' if n == 'NULL' else ''})"

    return with_models("\nUNION ALL ".join(map(one, (m for m in MODELS if m != "buildings_by_opportunity"))))


def raw(name: str) -> str:
    columns = ", ".join(c.name for c in RAW_TABLES[name].columns)
    return f"SELECT {columns} FROM ({MAPPING[name]})"


# The Z times of the CSV, as text on both sides.
ISO_DUCKDB = "%Y-%m-%dT%H:%M:%S.000Z"


def loaded_wide(only_first_file: tuple[str, ...] = ()) -> str:
    """The line-item wide table as the CSV load declares it.

    ``only_first_file`` columns are absent from the second file, that of the rows not won.
    """

    def value(c) -> str:
        q = _quoted(c.label)
        if c.role == "buildings":
            q = f"cast(to_json({q}) AS varchar)"
        elif c.load_type == "timestamp":
            q = f"strftime({q}, '{ISO_DUCKDB}')"
        elif c.load_type == "string":
            q = f"cast({q} AS varchar)"
        elif c.load_type.endswith(",0)"):
            q = f"cast({q} AS int)"
        else:
            q = f"cast({q} AS {c.load_type})"
        if c.label in only_first_file:
            q = f'CASE WHEN "受注済み" THEN {q} END'
        return f"{q} AS {_quoted(c.label)}"

    return with_models(f"SELECT {', '.join(value(c) for c in LINE_ITEM_WIDE)} FROM {LINE_WIDE}")


def headers(absent: tuple[str, ...]) -> str:
    """The headers of the first file, that of the rows won, and of the second; a file without rows has none."""
    first = [c.label for c in LINE_ITEM_WIDE]
    second = ["余分", *(n for n in reversed(first) if n not in absent)]
    parts = [
        f"SELECT (SELECT count(*) FROM {LINE_WIDE} WHERE coalesce(\"受注済み\", false) = {won}) AS row_count, "
        f"unnest(range({len(names)}))::INT AS place, unnest({names!r}) AS name"
        for won, names in (("true", first), ("false", second))
    ]
    return with_models(f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE row_count > 0")


def inferred_types() -> str:
    """Types of the opportunity wide columns; money shows as a decimal of the digits it has.

    Text of digits only, as the ids of the test tables are, shows as a number.
    """
    names = {
        "VARCHAR": "string",
        "INTEGER": "int",
        "BIGINT": "int",
        "BOOLEAN": "boolean",
        "DATE": "date",
        "TIMESTAMP": "timestamp",
    }
    kinds = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items())

    def money(column: str) -> str:
        whole, cents = (f"max(len(split_part(ltrim(cast({column} AS varchar), '-'), '.', {i})))" for i in (1, 2))
        return f"concat('decimal(', {whole} + {cents}, ',', {cents}, ')')"

    parts = [
        f"SELECT '{c.label}' AS name, CASE WHEN bool_and(regexp_full_match(cast({_quoted(c.label)} AS varchar), "
        f"'[0-9]{{10,18}}')) THEN 'bigint' ELSE CASE typeof(any_value({_quoted(c.label)})) {kinds} ELSE {money(_quoted(c.label))} END END AS type "
        "FROM gold_opportunity_wide"
        for c in OPPORTUNITY_WIDE
    ]
    return with_models(" UNION ALL ".join(parts))
