"""The date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelake import domain


def date_spine(spark: SparkSession, first: str = domain.CALENDAR_START,
               last: str = domain.CALENDAR_END) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def dim_date(spark: SparkSession, first: str = domain.CALENDAR_START,
             last: str = domain.CALENDAR_END) -> DataFrame:
    day = F.col("full_date")
    return date_spine(spark, first, last).select(
        day,
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        F.day(day).alias("day"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.weekofyear(day).alias("week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )
