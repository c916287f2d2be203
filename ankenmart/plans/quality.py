"""Data tests: every key of staging and marts must be filled and unique."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ankenmart.plans.staging import STAGING

NOT_NULL, UNIQUE = "not_null", "unique"

# Key of each tested model; the wide tables carry no test.
KEYS: dict[str, str] = {model: table.key for model, table in STAGING.items()} | {
    "dim_account": "account_id",
    "dim_asset": "asset_id",
    "dim_building": "building_id",
    "dim_date": "date_key",
    "dim_department": "department_id",
    "dim_product": "product_id",
    "dim_record_type": "record_type_id",
    "dim_user": "user_id",
    "bridge_opportunity_asset": "opportunity_asset_id",
    "bridge_opportunity_building": "opportunity_building_id",
    "fact_opportunity": "opportunity_id",
    "fact_opportunity_line_item": "line_item_id",
}


def failing_values(rows: DataFrame, column: str, test: str) -> DataFrame:
    """The failures of one test: NULL keys, or values seen more than once, with counts."""
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    if test == NOT_NULL:
        return counts.where(F.col("value").isNull())
    if test == UNIQUE:
        return counts.where(F.col("value").isNotNull() & (F.col("n") > 1))
    raise ValueError(f"unknown test {test!r}")


def run_tests(tables: Mapping[str, DataFrame], *tests: str) -> DataFrame:
    """One row a test: model, column, test, failures.

    All keys are counted together, so the tests are one scan of each key column and one
    shuffle, however many models there are. ``not_null`` counts rows, ``unique`` values; alone,
    each counts only the keys that can fail it, so ``not_null`` shuffles no value.
    """
    models = {model: column for model, column in KEYS.items() if model in tables}
    values = reduce(
        DataFrame.union,
        [
            tables[model].select(F.lit(model).alias("model"), F.col(column).cast("string").alias("value"))
            for model, column in models.items()
        ],
    )
    if tests and UNIQUE not in tests:
        values = values.where(F.col("value").isNull())
    elif tests and NOT_NULL not in tests:
        values = values.where(F.col("value").isNotNull())
    counts = values.groupBy("model", "value").agg(F.count(F.lit(1)).alias("n"))
    return results(counts, models, *tests)


def results(counts: DataFrame, models: Mapping[str, str], *tests: str) -> DataFrame:
    """The tests of models and their keys from (model, value, n) of every key value."""
    failed = F.col("value").isNotNull() & (F.col("n") > 1)
    by_model = counts.groupBy("model").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias(NOT_NULL),
        F.count(F.when(failed, F.lit(1))).alias(UNIQUE),
    )
    # A model without rows has no group, but its tests still pass: start from the list.
    listed = counts.sparkSession.createDataFrame(list(models.items()), "model string, column string")
    each = F.array(
        *[
            F.struct(F.lit(test).alias("test"), F.coalesce(F.col(test), F.lit(0)).alias("failures"))
            for test in tests or (NOT_NULL, UNIQUE)
        ]
    )
    # by_model has a row a model, 23 at most.
    return listed.join(F.broadcast(by_model), "model", "left").select("model", "column", F.inline(each))
