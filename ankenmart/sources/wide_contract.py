"""Columns of the two wide tables: where each comes from, its label, its load type.

``role.column`` names the side of the join: ``header`` and ``line`` are the two grains,
``buildings`` the arrays per opportunity, the others dimensions in the role they play.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class WideColumn:
    role: str
    column: str
    label: str
    load_type: str | None = None


def _columns(text: str) -> tuple[WideColumn, ...]:
    out = []
    for line in text.strip().splitlines():
        source, label, *load_type = line.split()
        role, column = source.split(".")
        out.append(WideColumn(role, column, label, load_type[0] if load_type else None))
    return tuple(out)


# The 45 columns of the opportunity wide table.
OPPORTUNITY_WIDE = _columns("""
    header.opportunity_id 商談ID
    header.opportunity_name 商談名
    header.amount 金額
    header.probability 確度
    header.expected_revenue 粗利金額
    header.contract_expectation_amount 受注予定金額
    header.total_quantity 数量
    header.stage_name フェーズ
    header.opportunity_type 商談タイプ
    header.lead_source リードソース
    header.forecast_category フォーキャストカテゴリ
    header.forecast_category_name フォーキャストカテゴリ名
    header.is_closed クローズ済み
    header.is_won 受注済み
    header.close_date_key クローズ日
    header.contract_expectation_date 受注予定日
    header.created_date 作成日
    header.last_modified_date 最終更新日
    header.last_activity_date 最終活動日
    header.last_stage_change_date 最終フェーズ変更日
    account.account_name 顧客名
    account.account_type 顧客タイプ
    account.billing_city 請求先市区町村
    account.billing_state 請求先都道府県
    account.billing_country 請求先国
    user.full_name 担当者名
    user.title 担当者役職
    user.division 担当者部門
    department.department_name 部署名
    department.parent_department_name 上位部署名
    department.area_code エリアコード
    department.mother_store_code 店所コード
    record_type.record_type_name レコードタイプ
    close.year クローズ年
    close.month クローズ月
    close.quarter クローズ四半期
    close.fiscal_year クローズ会計年度
    close.day_name クローズ曜日
    close.month_name クローズ月名
    close.year_month クローズ年月
    close.year_quarter クローズ年四半期
    close.is_weekend クローズ日週末フラグ
    contract.fiscal_year 受注予定会計年度
    contract.year_month 受注予定年月
    contract.year_quarter 受注予定年四半期
""")

# The 89 columns of the line-item wide table, with the type a CSV load declares.
LINE_ITEM_WIDE = _columns("""
    line.line_item_id 品目ID string
    header.opportunity_id 案件ID string
    header.opportunity_name 案件名 string
    line.work_number 工事番号 string
    line.building ビル string
    line.building_id ビルID string
    line.opportunity_building 商談ビル string
    line.delivery_model_name 配送モデル string
    line.bpr_model BPRモデル string
    line.opportunity_record_type 品目レコードタイプ string
    line.business_sheet_code 業務シートコード string
    line.sort_order 表示順 string
    line.service_date サービス日 string
    line.quantity 台数 decimal(9,0)
    line.discount 割引率 string
    line.unit_price 受注予定額 decimal(15,2)
    line.list_price 定価 decimal(15,2)
    line.subtotal 小計 decimal(15,2)
    line.total_price 合計金額 decimal(15,2)
    line.current_contract_amount 現契約金額 string
    line.bpr_estimated_amount ML decimal(15,2)
    line.offered_amount 提示金額 decimal(15,2)
    line.estimated_amount 見積金額 decimal(15,2)
    line.profit 利益 decimal(15,2)
    line.profit_ratio 利益率 decimal(9,2)
    line.ml_ratio ML比率 decimal(9,2)
    line.quotation_ratio 見積比率 decimal(9,2)
    line.increase_decrease 増減額 decimal(15,2)
    header.stage_name フェーズ string
    header.opportunity_type 商談タイプ string
    header.lead_source リードソース string
    header.forecast_category フォーキャストカテゴリ string
    header.forecast_category_name フォーキャストカテゴリ名 string
    header.contract_forecast 受注見込み・応札方針 string
    header.is_closed クローズ済み boolean
    header.is_won 受注済み boolean
    header.close_date クローズ日 date
    header.contract_expectation_date 受注予定日 date
    header.construction_start_date 建築着工日 date
    header.main_construction_start_date 本体着工日 date
    header.installation_period 据付工期 date
    header.contract_delivery_date 契約納期 date
    header.last_activity_date 最終活動日 date
    header.last_stage_change_date 最終フェーズ変更日 timestamp
    product.product_code 商品コード string
    product.product_name 商品名 string
    line.description 商品説明 string
    product.family 商品ファミリー string
    product.is_active 商品有効フラグ boolean
    product.is_archived 商品アーカイブフラグ boolean
    account.account_name 顧客名（契約先） string
    account.account_type 顧客タイプ（契約先） string
    account.billing_city 請求先市区町村 string
    account.billing_state 請求先都道府県 string
    account.billing_country 請求先国 string
    design.account_name 設計事務所 string
    building_owner.account_name 建物所有者（施主） string
    buildings.building_states 建物都道府県 string
    buildings.building_cities 建物市区町村 string
    buildings.building_streets 建物住所 string
    user.full_name 主担当者 string
    user.title 主担当者役職 string
    user.division 主担当者部門 string
    department.department_name 主担当部署 string
    department.parent_department_name 上位部署名 string
    department.area_code 受注エリア string
    department.mother_store_code 受注店所 string
    record_type.record_type_name レコードタイプ名 string
    close.year クローズ年 decimal(4,0)
    close.month クローズ月 decimal(2,0)
    close.quarter クローズ四半期 decimal(2,0)
    close.fiscal_year クローズ会計年度 decimal(4,0)
    close.day_name クローズ曜日 string
    close.month_name クローズ月名 string
    close.year_month クローズ年月 string
    close.year_quarter クローズ年四半期 string
    close.is_weekend クローズ日週末フラグ boolean
    contract.year 受注予定/年 decimal(4,0)
    contract.month 受注予定/月 decimal(2,0)
    contract.fiscal_year 受注予定年度 decimal(4,0)
    contract.year_month 受注予定年月 string
    contract.year_quarter 受注予定年四半期 string
    service.year サービス年 string
    service.month サービス月 string
    service.fiscal_year サービス会計年度 string
    service.year_month サービス年月 string
    service.year_quarter サービス年四半期 string
    line.created_date 品目作成日 timestamp
    line.last_modified_date 品目最終更新日 timestamp
""")

ARRAY_LABELS = tuple(c.label for c in LINE_ITEM_WIDE if c.role == "buildings")


def load_schema() -> T.StructType:
    """Schema of the table a wide CSV is loaded into. Whole numbers are integers there."""
    return T.StructType(
        [T.StructField(c.label, T.IntegerType() if c.load_type.endswith(",0)") else _type(c)) for c in LINE_ITEM_WIDE]
    )


def _type(column: WideColumn) -> T.DataType:
    return T.StructType.fromDDL(f"c {column.load_type}")["c"].dataType
