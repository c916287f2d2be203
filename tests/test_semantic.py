from __future__ import annotations

import datetime as dt
import decimal

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from ankenmart.plans.sales_semantics import LINE_ITEMS, QUESTIONS, question
from ankenmart.plans.semantic import AVG, COUNT, COUNT_DISTINCT, SUM, Member, Metric, SemanticModel

D = decimal.Decimal

MODEL = SemanticModel(
    name="sales",
    key="id",
    synonyms=("deals",),
    facts=(Member("amount", "amt"),),
    dimensions=(Member("area", "area/code", ("region",)), Member("phase", "ph", ("stage", "region")), Member("stage", "st")),
    metrics=(
        Metric("items", COUNT, "id"),
        Metric("deals", COUNT_DISTINCT, "deal"),
        Metric("total", SUM, "amt"),
        Metric("mean", AVG, "amt"),
        Metric("won deals", COUNT_DISTINCT, "deal", flag="won"),
        Metric("won total", SUM, "amt", flag="won"),
    ),
)
NAMES = [m.name for m in MODEL.metrics]


@pytest.fixture(scope="module")
def deals(spark):
    return spark.createDataFrame(
        [
            ("1", "d1", "A", "x", None, True, D("1.00")),
            ("2", "d1", "A", "x", None, True, D("2.00")),
            ("3", "d2", "A", "y", None, None, D("4.00")),
            (None, "d3", "A", "y", None, False, None),
            ("5", None, "A", "y", None, True, D("8.00")),
            ("6", "d4", None, "x", None, False, D("16.00")),
        ],
        "id string, deal string, `area/code` string, ph string, st string, won boolean, amt decimal(18,2)",
    )


def test_metrics_by_dimension_with_a_null_group(deals):
    assert rows(MODEL.query(deals, NAMES, ["area"])) == [
        ("A", 4, 3, D("15.00"), 3.75, 1, D("11.00")),
        (None, 1, 1, D("16.00"), 16.0, 0, None),
    ]


def test_without_dimensions_there_is_one_row(deals):
    assert rows(MODEL.query(deals, NAMES)) == [(5, 4, D("31.00"), 6.2, 1, D("11.00"))]
    assert rows(MODEL.query(deals.limit(0), NAMES)) == [(0, 0, None, None, 0, None)]


def test_plain_and_two_step_aggregates_agree(deals):
    apart = [MODEL.query(deals, [n], ["phase"]).alias(n) for n in NAMES]
    together = MODEL.query(deals, NAMES, ["phase"])
    for n, one in zip(NAMES, apart):
        assert rows(one) == rows(together.select("phase", f"`{n}`"))
        assert one.schema[n].dataType == together.schema[n].dataType


def test_two_distinct_counts_do_not_multiply_the_rows(deals):
    assert "Expand" not in plan_of(MODEL.query(deals, NAMES, ["area"]))


def test_synonyms_and_exact_names(deals):
    assert MODEL.dimension("stage").name == "stage"  # a name wins over a synonym
    assert MODEL.answers_to("deals") and MODEL.answers_to("sales") and not MODEL.answers_to("area")
    with pytest.raises(ValueError, match="ambiguous"):
        MODEL.dimension("region")
    for find in (MODEL.dimension, MODEL.fact, MODEL.metric):
        with pytest.raises(ValueError, match="unknown"):
            find("nothing")


def test_where_takes_a_value_a_list_or_null(deals):
    assert rows(MODEL.query(deals, ["items"], where={"area": "A"})) == [(4,)]
    assert rows(MODEL.query(deals, ["items"], where={"area": None})) == [(1,)]
    assert rows(MODEL.query(deals, ["items"], where={"area": [None, "A"]})) == [(5,)]
    assert rows(MODEL.query(deals, ["items"], where={"area": [None]})) == [(1,)]
    assert rows(MODEL.query(deals, ["items"], where={"phase": ["x", "y"], "area": "A"})) == [(4,)]


def test_order_and_limit(deals):
    ordered = MODEL.query(deals, ["total"], ["area"], order_by=["-total"]).collect()
    assert [r.total for r in ordered] == [D("16.00"), D("15.00")]
    assert [r.area for r in MODEL.query(deals, ["total"], ["area"], order_by=["area"]).collect()] == ["A", None]
    assert [r.area for r in MODEL.query(deals, ["total"], ["area"], order_by=["-area"], limit=1).collect()] == [None]


def test_facts_are_rows(deals):
    got = MODEL.query(deals, facts=["amount"], dimensions=["phase"])
    assert got.columns == ["phase", "amount"] and got.count() == 6
    with pytest.raises(ValueError, match="cannot be mixed"):
        MODEL.query(deals, ["total"], facts=["amount"])
    with pytest.raises(ValueError, match="nothing to query"):
        MODEL.query(deals)


def test_dimensions_alone_are_distinct(deals):
    assert rows(MODEL.query(deals, dimensions=["phase"])) == [("x",), ("y",)]


def test_member_counts_and_columns():
    assert (len(LINE_ITEMS.facts), len(LINE_ITEMS.dimensions), len(LINE_ITEMS.metrics)) == (8, 34, 10)
    assert LINE_ITEMS.dimension("customer").column == "顧客名（契約先）"
    assert LINE_ITEMS.dimension("建物所有者").column == "建物所有者（施主）"
    assert sum(bool(d.synonyms) for d in LINE_ITEMS.dimensions) == 9
    assert LINE_ITEMS.answers_to("受注明細")
    assert LINE_ITEMS.columns_for(metrics=["受注金額合計"], where={"クローズ会計年度": 2026}) == {
        "合計金額",
        "受注済み",
        "クローズ会計年度",
    }


def test_current_fiscal_year_follows_the_day():
    where = lambda day: question("won_amount_this_fiscal_year", day)["where"]
    assert where(dt.date(2026, 3, 31)) == {"クローズ会計年度": 2025}
    assert where(dt.date(2026, 4, 1)) == {"クローズ会計年度": 2026}
    assert len(QUESTIONS) == 5


def test_totals_do_not_depend_on_the_dimension(tables):
    from ankenmart.plans.wide import gold_opportunity_line_item_wide

    wide = gold_opportunity_line_item_wide(tables, ["合計金額", "品目ID", "フェーズ", "商品ファミリー", "受注エリア"])
    total = LINE_ITEMS.query(wide, ["合計金額合計", "品目件数"]).first()
    for d in ("フェーズ", "商品ファミリー", "受注エリア"):
        parts = LINE_ITEMS.query(wide, ["合計金額合計", "品目件数"], [d])
        assert parts.agg(F.sum("合計金額合計"), F.sum("品目件数")).first()[:] == total[:]
