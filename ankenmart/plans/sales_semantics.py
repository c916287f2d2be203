"""The semantic model over the line-item wide table, and its standing questions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ankenmart.functions.fiscal import fiscal_year_of
from ankenmart.plans.semantic import AVG, COUNT, COUNT_DISTINCT, SUM, Member, Metric, SemanticModel

# Names, physical columns and synonyms of the model's members.
LINE_ITEMS = SemanticModel(
    name="sv_opportunity_line_item",
    key="品目ID",
    synonyms=("商談品目", "案件品目", "受注明細", "opportunity line item"),
    facts=tuple(
        Member(name, name)
        for name in ("台数", "合計金額", "見積金額", "提示金額", "利益", "利益率", "小計", "定価")
    ),
    dimensions=(
        Member("案件ID", "案件ID"),
        Member("案件名", "案件名", ("商談名", "オポチュニティ名")),
        Member("工事番号", "工事番号"),
        Member("品目レコードタイプ", "品目レコードタイプ"),
        Member("フェーズ", "フェーズ", ("ステージ", "商談ステージ", "stage")),
        Member("フォーキャストカテゴリ名", "フォーキャストカテゴリ名"),
        Member("受注見込み・応札方針", "受注見込み・応札方針"),
        Member("クローズ済み", "クローズ済み"),
        Member("受注済み", "受注済み", ("受注", "成約", "Won")),
        Member("クローズ日", "クローズ日"),
        Member("クローズ年", "クローズ年"),
        Member("クローズ月", "クローズ月"),
        Member("クローズ四半期", "クローズ四半期"),
        Member("クローズ会計年度", "クローズ会計年度"),
        Member("クローズ年月", "クローズ年月"),
        Member("クローズ年四半期", "クローズ年四半期"),
        Member("受注予定日", "受注予定日"),
        Member("受注予定年度", "受注予定年度"),
        Member("受注予定年月", "受注予定年月"),
        Member("商品コード", "商品コード"),
        Member("商品名", "商品名", ("製品名", "プロダクト名")),
        Member("商品ファミリー", "商品ファミリー"),
        Member("顧客名", "顧客名（契約先）", ("取引先", "アカウント", "契約先", "customer")),
        Member("請求先都道府県", "請求先都道府県"),
        Member("請求先市区町村", "請求先市区町村"),
        Member("設計事務所", "設計事務所"),
        Member("建物所有者", "建物所有者（施主）"),
        Member("主担当者", "主担当者", ("営業担当", "担当者", "オーナー")),
        Member("主担当者役職", "主担当者役職"),
        Member("主担当部署", "主担当部署", ("部署", "営業部署")),
        Member("上位部署名", "上位部署名"),
        Member("受注エリア", "受注エリア", ("エリア", "地域")),
        Member("受注店所", "受注店所", ("店所", "支店")),
        Member("レコードタイプ名", "レコードタイプ名"),
    ),
    metrics=(
        Metric("品目件数", COUNT, "品目ID"),
        Metric("案件数", COUNT_DISTINCT, "案件ID"),
        Metric("合計金額合計", SUM, "合計金額"),
        Metric("見積金額合計", SUM, "見積金額"),
        Metric("提示金額合計", SUM, "提示金額"),
        Metric("利益合計", SUM, "利益"),
        Metric("台数合計", SUM, "台数"),
        Metric("平均利益率", AVG, "利益率"),
        Metric("受注案件数", COUNT_DISTINCT, "案件ID", flag="受注済み"),
        Metric("受注金額合計", SUM, "合計金額", flag="受注済み"),
    ),
)


def _questions(as_of: dt.date) -> dict[str, dict]:
    return {
        "won_amount_this_fiscal_year": dict(
            metrics=["受注金額合計"], where={"クローズ会計年度": fiscal_year_of(as_of)}
        ),
        "opportunities_and_won_amount_by_area": dict(
            metrics=["案件数", "受注金額合計"], dimensions=["受注エリア"]
        ),
        "mean_profit_ratio_by_product_family": dict(
            metrics=["平均利益率"], dimensions=["商品ファミリー"]
        ),
        "estimate_by_phase_largest_first": dict(
            metrics=["見積金額合計"], dimensions=["フェーズ"], order_by=["-見積金額合計"]
        ),
        "sales_by_close_fiscal_year": dict(
            metrics=["案件数", "合計金額合計", "受注金額合計"],
            dimensions=["クローズ会計年度"],
            order_by=["クローズ会計年度"],
        ),
    }


QUESTIONS = tuple(_questions(dt.date(2020, 1, 1)))


def question(name: str, as_of: dt.date) -> dict:
    """Arguments of ``LINE_ITEMS.query`` for a standing question."""
    return _questions(as_of)[name]


def answer(rows: DataFrame, name: str, as_of: dt.date) -> DataFrame:
    return LINE_ITEMS.query(rows, **question(name, as_of))
