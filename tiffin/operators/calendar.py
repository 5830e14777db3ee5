"""The calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dim_date(spark: SparkSession, start: date = date(2019, 1, 1), end: date = date(2028, 12, 31)) -> DataFrame:
    """One row per day, both ends included. Day of week counts from 0 = Sunday; the week is the ISO week."""
    days = (end - start).days + 1
    if days < 1:
        raise ValueError("the calendar ends before it starts")
    d = F.col("full_date")
    return (
        spark.range(0, days, 1, 1 + days // 100_000)
        .select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))
        .select(
            F.date_format(d, "yyyyMMdd").cast("bigint").alias("date_key"),
            d,
            F.year(d).alias("year"),
            F.month(d).alias("month"),
            F.date_format(d, "MMM").alias("month_short"),
            F.dayofmonth(d).alias("day_of_month"),
            (F.dayofweek(d) - 1).alias("day_of_week"),
            F.date_format(d, "EEE").alias("day_of_week_short"),
            F.weekofyear(d).alias("week_of_year"),
        )
    )
