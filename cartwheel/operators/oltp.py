"""Silver tables of the order system: casts, trims, and the item/order join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cartwheel.functions.scalars import as_double, as_int, as_long, as_stamp, month_slice, ymd

DAY_FORMAT = "yyyy-MM-dd"
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _trimmed(*names: str):
    return [F.trim(name).alias(name) for name in names]


def brands(bronze: DataFrame) -> DataFrame:
    return bronze.select(*_trimmed("brand_id", "brand_name", "brand_origin"))


def categories(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        as_long("category_id").alias("category_id"),
        F.trim("category_display_name").alias("category_name"),
        *_trimmed("category_description"),
    )


def customers(bronze: DataFrame) -> DataFrame:
    """Text columns are trimmed, the postal address is kept as typed."""
    return bronze.select(
        as_long("customer_id").alias("customer_id"),
        *_trimmed("first_name", "last_name", "email", "phone_number", "gender", "tier"),
        "address",
        as_stamp("created_at").alias("created_at"),
        as_stamp("updated_at").alias("updated_at"),
    )


def payment_method(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        as_long("payment_method_id").alias("payment_method_id"),
        *_trimmed("display_name", "provider", "type"),
    )


def products(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        as_long("product_id").alias("product_id"),
        *_trimmed("product_name", "product_description"),
        as_double("price").alias("price"),
        as_long("category_id").alias("category_id"),
        *_trimmed("brand_id"),
        as_stamp("created_at").alias("created_at"),
        as_stamp("updated_at").alias("updated_at"),
    )


def _parsed(bronze: DataFrame, column: str, kind: str, from_text: Column) -> Column:
    """``from_text`` for a text column, a plain cast for one already typed."""
    if isinstance(bronze.schema[column].dataType, StringType):
        return from_text
    return F.col(column).cast(kind)


def orders(bronze: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Order headers with the day split into partition columns.

    ``updated_at`` repeats ``created_at``: existing consumers rely on it.
    """
    day = _parsed(bronze, "order_date", "date", F.try_to_date("order_date", DAY_FORMAT))
    created = _parsed(
        bronze, "created_at", "timestamp", F.try_to_timestamp("created_at", F.lit(STAMP_FORMAT))
    )
    return bronze.where(month_slice(year, month)).select(
        as_long("order_id").alias("order_id"),
        as_long("customer_id").alias("customer_id"),
        day.alias("order_date"),
        as_double("total_amount").alias("total_amount"),
        as_long("payment_method_id").alias("payment_method_id"),
        created.alias("created_at"),
        created.alias("updated_at"),
        *ymd(day),
    )


def items(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        as_long("order_item_id").alias("order_item_id"),
        as_long("order_id").alias("order_id"),
        as_long("product_id").alias("product_id"),
        as_int("quantity").alias("quantity"),
        as_double("unit_price").alias("unit_price"),
        as_double("discount").alias("discount"),
    )


def items_with_order(bronze_items: DataFrame, silver_orders: DataFrame) -> DataFrame:
    """Items joined once with everything later steps need from their order.

    Both the silver items and the sales fact can be selected from this one
    frame, so a job that builds the two shuffles items and orders once.
    Items without an order are dropped.  Neither side is broadcast by hand:
    both grow with the data; a hot order is split by the adaptive skew join.
    """
    header = silver_orders.select(
        "order_id", "customer_id", "order_date", "payment_method_id", "year", "month", "day"
    )
    return items(bronze_items).join(header, "order_id")


def orders_items(
    bronze_items: DataFrame,
    silver_orders: DataFrame,
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """Silver items carrying their order's partition date.

    With a slice both sides are cut to the month before the join.
    """
    keep = month_slice(year, month)
    joined = items_with_order(bronze_items.where(keep), silver_orders.where(keep))
    return joined.select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount",
        "year", "month", "day",
    )
