"""Dimension tables of the sales mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.scalars import date_key, flag

SPINE_START = dt.date(2020, 1, 1)
SPINE_END = dt.date(2030, 12, 31)


def date_spine(spark: SparkSession, start: dt.date = SPINE_START, end: dt.date = SPINE_END) -> DataFrame:
    """One row per calendar day, both ends included."""
    days = F.sequence(F.lit(start), F.lit(end))
    return spark.range(1).select(F.explode(days).alias("calendar_date"))


def date_spine_of(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last date of a column."""
    day = F.col(column).cast("date")
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return span.select(F.explode(F.sequence("first", "last")).alias("calendar_date"))


def dim_date(spark: SparkSession, start: dt.date = SPINE_START, end: dt.date = SPINE_END) -> DataFrame:
    return date_attributes(date_spine(spark, start, end))


def date_attributes(spine: DataFrame) -> DataFrame:
    """Keys, names and flags of the days of a spine."""
    day = F.col("calendar_date")
    quarter = F.concat(F.lit("Q"), F.quarter(day).cast("string"))
    weekend = F.dayofweek(day).isin(1, 7)
    return spine.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.concat_ws("-", F.month(day).cast("string"), F.year(day).cast("string")).alias("month_year"),
        F.quarter(day).alias("quarter"),
        quarter.alias("quarter_name"),
        F.concat_ws("-", quarter, F.year(day).cast("string")).alias("quarter_year"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        flag(weekend).alias("is_weekend"),
        flag(~weekend).alias("is_weekday"),
    )


def dim_date_extended(
    dates: DataFrame, holidays: DataFrame | None = None, fiscal_start_month: int = 1
) -> DataFrame:
    """Adds day numbers, holiday flag and fiscal calendar to ``dim_date``.

    ``holidays`` is a table with a ``holiday_date`` column.  The fiscal year
    is named after the calendar year it starts in.
    """
    day = F.col("calendar_date")
    shifted = F.add_months(day, 1 - fiscal_start_month)
    out = dates.withColumns(
        {
            "day": F.day(day),
            "day_of_week": F.weekday(day) + 1,
            "fiscal_year": F.year(shifted),
            "fiscal_quarter": F.quarter(shifted),
        }
    )
    if holidays is None:
        return out.withColumn("is_holiday", F.lit(False))
    listed = holidays.select(
        F.col("holiday_date").alias("calendar_date"), F.lit(True).alias("listed")
    ).distinct()
    return (
        out.join(listed, "calendar_date", "left")
        .withColumn("is_holiday", F.coalesce("listed", F.lit(False)))
        .drop("listed")
    )


def dim_products(products: DataFrame, categories: DataFrame, brands: DataFrame) -> DataFrame:
    """Products with category and brand text; unknown ones stay NULL."""
    named_category = categories.select("category_id", F.col("category_name").alias("category"))
    return (
        products.join(named_category, "category_id", "left")
        .join(brands, "brand_id", "left")
        .select(
            "product_id", "product_name", "product_description", "price",
            "category", "brand_name", "brand_origin",
        )
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    """Customer attributes without contact data."""
    return customers.select("customer_id", "first_name", "last_name", "gender", "address", "tier")


def dim_payment_method(payment_method: DataFrame) -> DataFrame:
    return payment_method.select("payment_method_id", "display_name", "provider", "type")
