"""Extraction from the order database over JDBC, and month cuts of a table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(
    table: str, url: str, partition_column: str, lower: Any, upper: Any, partitions: int, fetch_size: int = 10_000
) -> dict[str, str]:
    """Reader options that split a table into parallel range reads.

    ``lower`` and ``upper`` only place the cuts; rows outside them are read too.
    """
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def extract_table(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A whole table, read by ``numPartitions`` tasks at once."""
    return spark.read.format("jdbc").options(**options).load()


def month_bounds(year: int, month: int) -> tuple[dt.date, dt.date]:
    """First day of the month and of the one after."""
    following = dt.date(year + month // 12, month % 12 + 1, 1)
    return dt.date(year, month, 1), following


def extract_month(orders: DataFrame, year: int, month: int) -> DataFrame:
    """Orders of one month.

    The range predicate on the bare column reaches the database or the file
    statistics; a formatted date would not.
    """
    first, following = month_bounds(year, month)
    day = F.col("order_date")
    return orders.where((day >= F.lit(first)) & (day < F.lit(following)))


def extract_month_items(items: DataFrame, orders: DataFrame, year: int, month: int) -> DataFrame:
    """Items of that month's orders, with their month as partition columns."""
    keys = extract_month(orders, year, month).select("order_id")
    return items.join(keys, "order_id", "left_semi").withColumns({"year": F.lit(year), "month": F.lit(month)})
