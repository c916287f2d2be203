"""Calendar and fiscal-year columns. The fiscal year starts in April."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

FISCAL_START_MONTH = 4


def fiscal_year(day: Column) -> Column:
    # Three months back, the fiscal year is the calendar year.
    return F.year(F.add_months(day, 1 - FISCAL_START_MONTH))


def fiscal_quarter(day: Column) -> Column:
    return F.quarter(F.add_months(day, 1 - FISCAL_START_MONTH))


def fiscal_year_quarter(day: Column) -> Column:
    return F.concat(
        fiscal_year(day).cast("string"), F.lit("-Q"), fiscal_quarter(day).cast("string")
    )


def weekday_from_sunday(day: Column) -> Column:
    """Sunday is 0 and Saturday is 6."""
    return F.dayofweek(day) - 1


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def fiscal_year_of(day: dt.date) -> int:
    return day.year if day.month >= FISCAL_START_MONTH else day.year - 1
