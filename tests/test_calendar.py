from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ankenmart.functions.fiscal import fiscal_year_of
from ankenmart.plans.calendar import dim_date


def _day(spark, day):
    return dim_date(spark, dt.date(2026, 12, 2)).where(F.col("date_key") == F.lit(day)).first()


def test_range(spark):
    rows = dim_date(spark, dt.date(2026, 12, 2))
    assert rows.count() == 4354
    assert rows.agg(F.min("date_key"), F.max("date_key")).first()[:] == (
        dt.date(2020, 1, 1),
        dt.date(2031, 12, 2),
    )


def test_leap_day_clamps(spark):
    assert dim_date(spark, dt.date(2024, 2, 29)).agg(F.max("date_key")).first()[0] == dt.date(2029, 2, 28)


def test_default_is_today(spark):
    today = spark.sql("SELECT add_months(current_date(), 60)").first()[0]
    assert dim_date(spark).agg(F.max("date_key")).first()[0] == today


def test_fiscal_year_turns_in_april(spark):
    before, after = _day(spark, dt.date(2024, 3, 31)), _day(spark, dt.date(2024, 4, 1))
    assert (before.fiscal_year, before.quarter, before.year_quarter) == (2023, 4, "2023-Q4")
    assert (after.fiscal_year, after.quarter, after.year_quarter) == (2024, 1, "2024-Q1")
    assert fiscal_year_of(dt.date(2024, 3, 31)) == 2023 and fiscal_year_of(dt.date(2024, 4, 1)) == 2024


def test_names_and_weekend(spark):
    sunday = _day(spark, dt.date(2024, 3, 31))
    assert sunday[:] == (
        dt.date(2024, 3, 31), 2024, 3, 31, 2023, 4, 0, "Sunday", "March", "2024-03", "2023-Q4", True,
    )
    saturday = _day(spark, dt.date(2024, 3, 30))
    assert (saturday.day_of_week, saturday.is_weekend) == (6, True)
    assert _day(spark, dt.date(2024, 4, 1)).is_weekend is False
