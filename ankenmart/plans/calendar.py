"""The calendar dimension, 2020-01-01 to five years after ``as_of``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ankenmart.functions import fiscal

FIRST_DAY = dt.date(2020, 1, 1)
YEARS_AHEAD = 5


def dim_date(spark: SparkSession, as_of: dt.date | None = None) -> DataFrame:
    today = F.current_date() if as_of is None else F.lit(as_of)
    last_day = F.add_months(today, 12 * YEARS_AHEAD)
    day = F.col("date_key")
    return (
        spark.range(1, numPartitions=1)
        .select(F.explode(F.sequence(F.lit(FIRST_DAY), last_day)).alias("date_key"))
        .select(
            day,
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            fiscal.fiscal_year(day).alias("fiscal_year"),
            fiscal.fiscal_quarter(day).alias("quarter"),
            fiscal.weekday_from_sunday(day).alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.date_format(day, "yyyy-MM").alias("year_month"),
            fiscal.fiscal_year_quarter(day).alias("year_quarter"),
            fiscal.is_weekend(day).alias("is_weekend"),
        )
    )
