from __future__ import annotations

from conftest import plan_of, rows
from pyspark.sql import functions as F

import pytest

from ankenmart.operators.fan_out import hot_keys
from ankenmart.plans.wide import (
    buildings_by_opportunity,
    gold_opportunity_line_item_wide,
    gold_opportunity_wide,
    line_item_wide_by_opportunity,
    write_by_opportunity,
)
from ankenmart.sources.wide_contract import LINE_ITEM_WIDE, OPPORTUNITY_WIDE, load_schema

FACT_NAMES = {
    "bpr_estimated_amount": "ml_amount",
    "created_date": "line_item_created_date",
    "last_modified_date": "line_item_last_modified_date",
}
JOINS = {
    "account": ("account_id", "dim_account", "account_id"),
    "design": ("design_id", "dim_account", "account_id"),
    "building_owner": ("building_owner_id", "dim_account", "account_id"),
    "product": ("product_id", "dim_product", "product_id"),
    "user": ("owner_id", "dim_user", "user_id"),
    "department": ("department_id", "dim_department", "department_id"),
    "record_type": ("record_type_id", "dim_record_type", "record_type_id"),
    "close": ("close_date", "dim_date", "date_key"),
    "contract": ("contract_expectation_date", "dim_date", "date_key"),
    "service": ("service_date", "dim_date", "date_key"),
}


def _fact_first(tables):
    """The definition: the line-item fact left joined to every dimension."""
    fact = tables["fact_opportunity_line_item"].alias("f")
    joined = fact
    for role, (on, dimension, key) in JOINS.items():
        joined = joined.join(
            tables[dimension].alias(role), F.col(f"f.{on}") == F.col(f"{role}.{key}"), "left"
        )
    joined = joined.join(
        buildings_by_opportunity(tables).alias("buildings"),
        F.col("f.opportunity_id") == F.col("buildings.opportunity_id"),
        "left",
    )

    def source(c):
        if c.role == "line":
            return f"f.{FACT_NAMES.get(c.column, c.column)}"
        return f"f.{c.column}" if c.role == "header" else f"{c.role}.{c.column}"

    return joined.select(*[F.col(source(c)).alias(c.label) for c in LINE_ITEM_WIDE])


def test_contract_sizes(spark):
    assert len(OPPORTUNITY_WIDE) == 45 and len(LINE_ITEM_WIDE) == 89
    kinds = [c.load_type for c in LINE_ITEM_WIDE]
    numbers = ["decimal(15,2)", "decimal(9,2)", "decimal(9,0)", "decimal(4,0)", "decimal(2,0)"]
    assert [kinds.count(k) for k in numbers] == [9, 3, 1, 4, 3]
    assert len(load_schema()) == 89


def test_attaching_header_dimensions_first_gives_the_same_rows(tables):
    got, want = gold_opportunity_line_item_wide(tables), _fact_first(tables)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_the_same_with_repeated_dimension_keys_and_hot_opportunities(tables):
    repeated = dict(tables)
    for name, key in (("dim_account", "account_id"), ("dim_product", "product_id")):
        repeated[name] = tables[name].unionByName(tables[name].where(F.col(key).endswith("5")))
    hot = hot_keys(tables["stg_opportunity_line_item"], "opportunity_id", slice_rows=4)
    assert hot.count() > 100
    got = gold_opportunity_line_item_wide(repeated, hot=hot)
    want = _fact_first(repeated)
    assert rows(got) == rows(want)


def test_fewer_labels_give_the_same_columns_from_fewer_joins(tables):
    labels = ["案件ID", "フェーズ", "合計金額"]
    got = gold_opportunity_line_item_wide(tables, labels)
    assert got.columns == ["案件ID", "合計金額", "フェーズ"]
    assert rows(got) == rows(gold_opportunity_line_item_wide(tables).select(*got.columns))
    plan = plan_of(got)
    # Dimensions that none of the labels needs are not even read.
    assert not [t for t in ("nation", "supplier", "part", "events") if f"/{t}.parquet" in plan]
    with pytest.raises(ValueError, match="no wide column"):
        gold_opportunity_line_item_wide(tables, ["何か"])


def test_arrays_are_empty_without_values_and_null_without_buildings(spark):
    bridge = spark.createDataFrame(
        [("o1", "b1"), ("o1", "b2"), ("o1", "b1"), ("o2", "b3"), ("o3", "gone")],
        "opportunity_id string, building_id string",
    )
    building = spark.createDataFrame(
        [("b1", "S2", "c", None), ("b2", "S1", "c", None), ("b3", None, None, None)],
        "building_id string, address_state string, address_city string, address_street string",
    )
    got = buildings_by_opportunity({"bridge_opportunity_building": bridge, "dim_building": building})
    assert rows(got) == [
        ("o1", ["S1", "S2"], ["c"], []),
        ("o2", [], [], []),
        ("o3", [], [], []),
    ]


def test_wide_table_has_null_arrays_without_buildings(tables):
    wide = gold_opportunity_line_item_wide(tables, ["案件ID", "建物都道府県"])
    linked = tables["bridge_opportunity_building"].select("opportunity_id").distinct()
    alone = wide.join(linked, F.col("案件ID") == F.col("opportunity_id"), "left_anti")
    assert alone.count() > 0 and alone.where("`建物都道府県` IS NOT NULL").count() == 0
    assert wide.where("size(`建物都道府県`) = 0").count() > 0


def test_dates_outside_the_calendar_give_null(tables):
    wide = gold_opportunity_wide(tables, ["受注予定日", "受注予定会計年度"])
    early = wide.where("`受注予定日` < DATE '2020-01-01'")
    assert early.count() > 0 and early.where("`受注予定会計年度` IS NOT NULL").count() == 0


def test_tables_written_by_opportunity_join_without_an_exchange(spark, tables, tmp_path):
    write_by_opportunity(tables, "written_by_opportunity", str(tmp_path), buckets=5, slice_rows=2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        wide = line_item_wide_by_opportunity(spark, "written_by_opportunity")
        plan = plan_of(wide)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2 and "Bucketed: true" in plan
    assert rows(wide) == rows(gold_opportunity_line_item_wide(tables))
    lines = spark.table("written_by_opportunity.lines")
    slices = lines.groupBy("opportunity_id").agg(F.count_distinct("_slice").alias("slices"), F.count(F.lit(1)).alias("n"))
    assert slices.where("n > 2 AND slices > 1").count() > 100 and slices.where("n <= 2 AND slices > 1").count() == 0
    # A hot opportunity is in several buckets, that is in several files.
    files = lines.groupBy("opportunity_id").agg(F.count_distinct("_metadata.file_path").alias("files"))
    assert files.where("files > 1").count() > 100


def test_calendar_columns_are_in_no_shuffle_of_the_join(spark, tables):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(gold_opportunity_line_item_wide(tables, ["案件ID", "品目ID", "サービス年月", "クローズ年月", "受注予定年月"]))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # The calendar joins come after the one of headers and lines, that is above it in the plan.
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) >= 4 and all("BroadcastHashJoin" in j and "__key" in j for j in joins[:3])


def test_more_buckets_than_asked_for_when_the_lines_are_many(spark, tables, tmp_path, monkeypatch):
    from ankenmart.operators import colocated

    lines = tables["stg_opportunity_line_item"].count()
    monkeypatch.setattr(colocated.buckets_for, "__defaults__", (-(-lines // 7),))
    write_by_opportunity(tables, "written_in_more_buckets", str(tmp_path), buckets=2)
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED written_in_more_buckets.lines").collect()}
    assert described["Num Buckets"] == "7"
