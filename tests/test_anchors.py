"""Row counts and totals known beforehand for the smallest tables."""

from __future__ import annotations

import decimal

from pyspark.sql import functions as F

from ankenmart.plans.sales_semantics import LINE_ITEMS
from ankenmart.plans.wide import (
    buildings_by_opportunity,
    gold_opportunity_line_item_wide,
    gold_opportunity_wide,
)


def test_row_counts(tables):
    assert tables["stg_opportunity"].count() == 1441
    assert tables["stg_opportunity_line_item"].count() == 5904
    fact = tables["fact_opportunity_line_item"]
    assert fact.count() == 5690
    assert fact.where("line_item_id IS NULL").count() == 27


def test_wide_tables_keep_the_rows_of_their_facts(tables):
    assert gold_opportunity_wide(tables).count() == 1441
    assert gold_opportunity_line_item_wide(tables).count() == 5690


def test_buildings(tables):
    # Counted over lineitem and supplier: orders with a link that is not deleted (l_suppkey % 19 <> 18), and
    # those of them none of whose suppliers is a building with a state (s_suppkey % 11 <> 0, % 23 <> 22).
    rows = buildings_by_opportunity(tables)
    assert rows.count() == 1473
    assert rows.where(F.size("building_states") == 0).count() == 9


def test_metric_totals(tables):
    got = LINE_ITEMS.query(
        gold_opportunity_line_item_wide(tables), [m.name for m in LINE_ITEMS.metrics]
    ).first()
    assert got.asDict() == {
        "品目件数": 5663,
        "案件数": 1441,
        "合計金額合計": decimal.Decimal("283279483.80"),
        "見積金額合計": decimal.Decimal("373005967.51"),
        "提示金額合計": decimal.Decimal("335705367.78"),
        "利益合計": decimal.Decimal("37300599.58"),
        "台数合計": 144078,
        "平均利益率": 19.506621931838247,
        "受注案件数": 464,
        "受注金額合計": decimal.Decimal("92540368.96"),
    }
