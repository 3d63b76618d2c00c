"""Date bounds of the data and the calendar dimension."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telcolake.functions.dates import date_key

# Default bounds of the calendar.
CALENDAR_START = date(2020, 1, 1)
CALENDAR_END = date(2026, 12, 31)

DATE_COLUMNS = {
    "customers": ("onboarded_date", "churn_date"),
    "network_telemetry": ("date",),
    "support_tickets": ("open_date", "close_date"),
    "billing_events": ("billing_month", "payment_date"),
}


def date_bounds(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Earliest and latest date of all date columns, with one scan per table."""
    per_table = []
    for name, columns in DATE_COLUMNS.items():
        lows = [F.min(c) for c in columns]
        highs = [F.max(c) for c in columns]
        per_table.append(silver[name].agg(_least(lows).alias("low"), _greatest(highs).alias("high")))
    bounds = reduce(DataFrame.unionByName, per_table)
    return bounds.agg(F.min("low").alias("earliest_date"), F.max("high").alias("latest_date"))


def earliest_date(silver: Mapping[str, DataFrame]) -> DataFrame:
    return date_bounds(silver).select("earliest_date")


def latest_date(silver: Mapping[str, DataFrame]) -> DataFrame:
    return date_bounds(silver).select("latest_date")


def days_between(bounds: DataFrame, start: Column | str, end: Column | str) -> DataFrame:
    """One row per day for every row of ``bounds``."""
    return bounds.select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("date"))


def date_spine(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    return days_between(spark.range(1), F.lit(start), F.lit(end))


def with_calendar_columns(days: DataFrame) -> DataFrame:
    weekday = F.dayofweek("date")  # 1 = Sunday ... 7 = Saturday
    return days.select(
        "date",
        date_key("date").alias("date_key"),
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        weekday.alias("day_of_week"),
        weekday.isin(1, 7).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    return with_calendar_columns(date_spine(spark, start, end))


def calendar_head_tail(calendar: DataFrame, n: int = 5) -> DataFrame:
    """The first and the last ``n`` days, marked ``head`` and ``tail``."""
    head = calendar.orderBy("date").limit(n).withColumn("part", F.lit("head"))
    tail = calendar.orderBy(F.desc("date")).limit(n).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


def _least(columns: list[Column]) -> Column:
    return F.least(*columns) if len(columns) > 1 else columns[0]


def _greatest(columns: list[Column]) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else columns[0]
