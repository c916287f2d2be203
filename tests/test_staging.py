from __future__ import annotations

import decimal

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from ankenmart.plans.staging import STAGING, stage, staged
from ankenmart.sources.raw import RAW_TABLES, catalog_source, conform, frame_source, parquet_source, raw_table


def _raw(spark, name, **values):
    """One raw row of a table, NULL but for the given values."""
    table = RAW_TABLES[name]
    return spark.createDataFrame([tuple(values.get(c.name) for c in table.columns)], table.schema)


def test_flag_must_be_false(spark):
    table = STAGING["stg_account"]
    for flag, kept in ((False, 1), (True, 0), (None, 0)):
        assert stage(_raw(spark, "account", Id="1", IsDeleted=flag), table).count() == kept


def test_record_types_must_be_active_and_users_are_all_kept(spark):
    for flag, kept in ((True, 1), (False, 0), (None, 0)):
        assert stage(_raw(spark, "recordtype", Id="1", IsActive=flag), STAGING["stg_record_type"]).count() == kept
    assert stage(_raw(spark, "user", Id="1"), STAGING["stg_user"]).count() == 1


@pytest.mark.parametrize("value, want", [(2.4, 2), (2.5, 3), (2.6, 3), (-2.5, -3), (None, None)])
def test_int_casts_round(spark, value, want):
    rows = stage(_raw(spark, "building__c", Id="1", NumberOfFloors__c=value, IsDeleted=False), STAGING["stg_building"])
    assert rows.first().number_of_floors == want


def test_int_cast_of_text(spark):
    rows = _raw(spark, "building__c", Id="1", IsDeleted=False).withColumn("NumberOfFloors__c", F.lit("3.0"))
    assert stage(rows, STAGING["stg_building"]).first().number_of_floors == 3


def test_money_rounds_half_up(spark):
    rows = stage(
        _raw(spark, "opportunity", Id="1", Amount=decimal.Decimal("1.005000"), IsDeleted=False),
        STAGING["stg_opportunity"],
    )
    assert rows.first().amount == decimal.Decimal("1.01")
    assert rows.schema["amount"].dataType.simpleString() == "decimal(18,2)"


def test_column_counts():
    want = dict(
        stg_account=13, stg_asset=15, stg_building=19, stg_department=10, stg_opportunity=31,
        stg_opportunity_asset=6, stg_opportunity_building=5, stg_opportunity_line_item=34,
        stg_product=9, stg_record_type=5, stg_user=12,
    )
    assert {m: sum(c.staged is not None for c in t.columns) for m, t in STAGING.items()} == want


def test_names_match_without_case_and_missing_ones_are_told(spark):
    rows = _raw(spark, "user", Id="1", Username="u")
    lower = rows.toDF(*[c.lower() for c in rows.columns])
    assert conform(lower, raw_table("user")).columns == [c.name for c in raw_table("user").columns]
    with pytest.raises(ValueError, match="lacks Title"):
        conform(rows.drop("Title"), raw_table("user"))
    with pytest.raises(ValueError, match="no raw table"):
        frame_source({})("nothing")


def test_filter_and_columns_reach_the_parquet_scan(spark, tmp_path):
    _raw(spark, "account", Id="1", IsDeleted=False).write.parquet(str(tmp_path / "account"))
    rows = staged(parquet_source(spark, str(tmp_path)), "stg_account").select("account_name")
    plan = plan_of(rows)
    assert "PushedFilters: [IsNotNull(IsDeleted), Not(EqualTo(IsDeleted,true))]" in plan
    assert "ReadSchema: struct<Name:string,IsDeleted:boolean>" in plan


def test_catalog_source_quotes_reserved_names(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS salesforce")
    _raw(spark, "user", Id="1").write.mode("overwrite").saveAsTable("salesforce.`user`")
    assert staged(catalog_source(spark), "stg_user").first().user_id == "1"
    spark.sql("DROP DATABASE salesforce CASCADE")
