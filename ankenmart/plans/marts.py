"""Dimensions, bridges and facts as functions of the staging DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ankenmart.operators.fan_out import fan_out, hot_keys
from ankenmart.operators.layout import Ranges
from ankenmart.operators.projection import renamed

Staged = Mapping[str, DataFrame]

#: Tables that can be cut into parts by opportunity, and their column of it; the largest.
BY_OPPORTUNITY = dict.fromkeys(
    ("stg_opportunity", "stg_opportunity_line_item", "stg_opportunity_building", "bridge_opportunity_building"), "opportunity_id"
)
LINES = "stg_opportunity_line_item"

# Columns of the two facts in output order, "name" or "source output".
FACT_OPPORTUNITY = """
    opportunity_id
    account_id
    owner_id user_id
    record_type_id
    department_id
    close_date close_date_key
    amount
    probability
    expected_revenue
    contract_expectation_amount
    total_quantity
    opportunity_name
    stage_name
    opportunity_type
    lead_source
    forecast_category
    forecast_category_name
    is_closed
    is_won
    contract_expectation_date
    created_date
    last_modified_date
    last_activity_date
    last_stage_change_date
"""
LINE_FACT_HEADER = """
    account_id
    record_type_id
    owner_id
    department_id
    design_id
    building_owner_id
    opportunity_name
    stage_name
    opportunity_type
    lead_source
    forecast_category
    forecast_category_name
    contract_forecast
    is_closed
    is_won
    close_date
    contract_expectation_date
    construction_start_date
    main_construction_start_date
    installation_period
    contract_delivery_date
    last_activity_date
    last_stage_change_date
"""
LINE_FACT_DETAIL = """
    product_id
    pricebook_entry_id
    product_code
    product_name
    description
    work_number
    building
    building_id
    opportunity_building
    delivery_model_name
    bpr_model
    opportunity_record_type
    business_sheet_code
    sort_order
    service_date
    quantity
    discount
    unit_price
    list_price
    subtotal
    total_price
    current_contract_amount
    bpr_estimated_amount ml_amount
    offered_amount
    estimated_amount
    profit
    profit_ratio
    ml_ratio
    quotation_ratio
    increase_decrease
    created_date line_item_created_date
    last_modified_date line_item_last_modified_date
"""
DIM_ASSET = """
    asset_id
    asset_name
    serial_number
    status
    product_code
    product_family
    product_name
    install_date
    manufacture_date
    purchase_date
    usage_end_date
    is_competitor_product
    account_id
"""


def _pairs(columns: str) -> list[tuple[str, str]]:
    return [(words[0], words[-1]) for words in (line.split() for line in columns.split("\n")) if words]


def _select(rows: DataFrame, columns: str) -> DataFrame:
    return renamed(rows, _pairs(columns))


def dim_account(staged: Staged) -> DataFrame:
    return staged["stg_account"].drop("record_type_id")


def dim_asset(staged: Staged) -> DataFrame:
    return _select(staged["stg_asset"], DIM_ASSET)


def dim_building(staged: Staged) -> DataFrame:
    return staged["stg_building"]


def dim_department(staged: Staged) -> DataFrame:
    return staged["stg_department"]


def dim_product(staged: Staged) -> DataFrame:
    return staged["stg_product"]


def dim_record_type(staged: Staged) -> DataFrame:
    return staged["stg_record_type"]


def dim_user(staged: Staged) -> DataFrame:
    return staged["stg_user"]


def bridge_opportunity_asset(staged: Staged) -> DataFrame:
    return staged["stg_opportunity_asset"].drop("name")


def bridge_opportunity_building(staged: Staged) -> DataFrame:
    return staged["stg_opportunity_building"].drop("name")


def fact_opportunity(staged: Staged) -> DataFrame:
    return _select(staged["stg_opportunity"], FACT_OPPORTUNITY)


def hot_opportunities(staged: Staged) -> DataFrame:
    """Opportunities with so many lines that the joins to the lines must split them."""
    return hot_keys(staged["stg_opportunity_line_item"], "opportunity_id")


def rows_by_opportunity(staged: Staged) -> DataFrame:
    """The number of ``lines`` of each opportunity, and of its ``rows``, lines and headers, without NULL."""
    tables = {"stg_opportunity": 0, "stg_opportunity_line_item": 1}
    headers, lines = (staged[t].select("opportunity_id", F.lit(n).alias("lines")) for t, n in tables.items())
    both = headers.unionByName(lines).where("opportunity_id IS NOT NULL")
    return both.groupBy("opportunity_id").agg(F.sum("lines").alias("lines"), F.count(F.lit(1)).alias("rows"))


def fact_opportunity_line_item(staged: Staged, hot: DataFrame | None = None, ranges: Ranges | None = None) -> DataFrame:
    """Header left join detail: a header without lines gives one row with a NULL line id.

    ``ranges`` of the opportunities partition the result."""
    hot = hot_opportunities(staged) if hot is None else hot
    header = _select(staged["stg_opportunity"], "opportunity_id" + LINE_FACT_HEADER)
    detail = _select(
        staged["stg_opportunity_line_item"], "opportunity_id\nline_item_id" + LINE_FACT_DETAIL
    )
    joined = fan_out(header, detail, "opportunity_id", "line_item_id", hot, ranges=ranges)
    order = "opportunity_id\nline_item_id" + LINE_FACT_HEADER + LINE_FACT_DETAIL
    return renamed(joined, [(name, name) for _, name in _pairs(order)])


# Marts that are projections or one join of staging; the calendar and wide tables follow.
MARTS: dict[str, Callable[[Staged], DataFrame]] = {
    f.__name__: f
    for f in (
        dim_account,
        dim_asset,
        dim_building,
        dim_department,
        dim_product,
        dim_record_type,
        dim_user,
        bridge_opportunity_asset,
        bridge_opportunity_building,
        fact_opportunity,
        fact_opportunity_line_item,
    )
}
