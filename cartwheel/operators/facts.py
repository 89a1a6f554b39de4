"""Fact tables of the sales mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scalars import date_key, money_sum, month_slice


def fact_orders(orders: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    return orders.where(month_slice(year, month)).select(
        "order_id",
        F.col("customer_id").alias("customer_key"),
        date_key("order_date").alias("date_key"),
        F.col("payment_method_id").alias("payment_method_key"),
        "total_amount",
        "year", "month", "day",
    )


def sales_lines(items_with_order: DataFrame) -> DataFrame:
    """Measures per item line, with the order id kept for order-level counts.

    Takes ``oltp.items_with_order``.  ``discount_percent`` is a fraction.
    """
    gross = F.col("unit_price") * F.col("quantity")
    off = gross * F.col("discount")
    return items_with_order.select(
        "order_item_id",
        "order_id",
        F.col("customer_id").alias("customer_key"),
        date_key("order_date").alias("date_key"),
        F.col("payment_method_id").alias("payment_method_key"),
        F.col("product_id").alias("product_key"),
        "quantity",
        "unit_price",
        F.col("discount").alias("discount_percent"),
        gross.alias("sub_total"),
        off.alias("discount_amt"),
        (gross - off).alias("total_amount"),
        "year", "month", "day",
    )


def fact_sales(
    orders_items: DataFrame, orders: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Sales lines from the two silver tables."""
    keep = month_slice(year, month)
    header = orders.where(keep).select("order_id", "customer_id", "order_date", "payment_method_id")
    return sales_lines(orders_items.where(keep).join(header, "order_id"))


def fact_order_items(
    orders_items: DataFrame, orders: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """The stored line fact: ``fact_sales`` without the order id."""
    return fact_sales(orders_items, orders, year, month).drop("order_id")


def fact_sale_product_daily(sales: DataFrame) -> DataFrame:
    """Product by day.  The order count appears when the input has order ids."""
    totals = [
        money_sum("sub_total").alias("total_sales_amt"),
        F.sum("quantity").alias("total_quantity_sold"),
        money_sum("discount_amt").alias("total_discount_amount"),
    ]
    if "order_id" in sales.columns:
        totals.append(F.count_distinct("order_id").alias("total_order_count"))
    daily = sales.groupBy("date_key", "product_key").agg(*totals)
    return daily.select(
        F.concat_ws("_", F.col("date_key").cast("string"), F.col("product_key").cast("string")).alias(
            "product_date_key"
        ),
        "*",
        F.try_divide("total_sales_amt", "total_quantity_sold").alias("avg_unit_price"),
    )
