"""Reports over sales.

Most reports take *order totals*: one row per order with exact decimal sums.
``per_order`` derives them from the stored sales fact, ``order_totals`` from
items and orders.  From there on joins and distinct counts see orders,
customers or days, never single lines, so an order with very many lines costs
no more than any other.  Product reports take the sales lines themselves.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.scalars import date_key, flag, money_sum, quotient

MONEY = "decimal(28,4)"


def since_key(since: dt.date | str | None, until: dt.date | str | None = None) -> Column:
    """Filter on ``date_key``, both ends included; an end not given is open."""
    kept = F.lit(True)
    if since is not None:
        kept = kept & (F.col("date_key") >= date_key(F.lit(since).cast("date")))
    if until is not None:
        kept = kept & (F.col("date_key") <= date_key(F.lit(until).cast("date")))
    return kept


def _line_totals() -> list[Column]:
    def exact(column: str) -> Column:
        return F.sum(F.col(column).cast("decimal(18,4)")).cast(MONEY)

    return [
        exact("sub_total").alias("revenue"),
        exact("discount_amt").alias("discount"),
        exact("unit_price").alias("unit_prices"),
        F.count("sub_total").alias("priced_lines"),
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("units"),
    ]


def per_order(sales: DataFrame) -> DataFrame:
    """Order totals from the sales fact."""
    return sales.groupBy("order_id", "customer_key", "date_key").agg(*_line_totals())


def order_totals(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order totals from silver-typed items and silver orders.

    Lines are summed per order before the join.  Map tasks already combine
    the lines of a hot order, and the join meets one row per order on the
    partitioning the sum left behind.
    """
    gross = F.col("unit_price") * F.col("quantity")
    summed = (
        items.select(
            "order_id", "quantity", "unit_price",
            gross.alias("sub_total"),
            (gross * F.col("discount")).alias("discount_amt"),
        )
        .groupBy("order_id")
        .agg(*_line_totals())
    )
    header = orders.select(
        "order_id", F.col("customer_id").alias("customer_key"), date_key("order_date").alias("date_key")
    )
    return summed.join(header, "order_id")


def _total(column: str) -> Column:
    return F.sum(column).cast("double")


def daily_sales(
    totals: DataFrame, dim_date: DataFrame, since: dt.date | str | None = None, until: dt.date | str | None = None
) -> DataFrame:
    """Revenue, orders and mean line value by calendar day."""
    daily = (
        totals.where(since_key(since, until))
        .groupBy("date_key")
        .agg(
            _total("revenue").alias("daily_revenue"),
            F.count("order_id").alias("order_count"),
            F.sum("priced_lines").alias("line_count"),
        )
    )
    return daily.join(dim_date.select("date_key", "calendar_date", "day_name"), "date_key").select(
        "calendar_date",
        "day_name",
        "daily_revenue",
        "order_count",
        F.try_divide("daily_revenue", "line_count").alias("avg_line_item_value"),
    ).orderBy(F.desc("calendar_date"))


def tier_value(totals: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Customers, revenue and orders by loyalty tier."""
    per_customer = (
        totals
        .groupBy("customer_key")
        .agg(F.sum("revenue").cast(MONEY).alias("revenue"), F.count("order_id").alias("orders"))
    )
    tiers = (
        per_customer.join(dim_customers, per_customer.customer_key == dim_customers.customer_id)
        .groupBy("tier")
        .agg(
            F.count("customer_key").alias("customer_count"),
            _total("revenue").alias("total_revenue"),
            F.sum("orders").alias("orders"),
        )
    )
    return tiers.select(
        F.col("tier").alias("customer_tier"),
        "customer_count",
        "total_revenue",
        quotient(F.col("total_revenue"), F.col("customer_count")).alias("revenue_per_customer"),
        quotient(F.col("orders"), F.col("customer_count")).alias("avg_orders_per_customer"),
    ).orderBy(F.desc("total_revenue"), "customer_tier")


def weekday_sales(totals: DataFrame, dim_date: DataFrame, since: dt.date | str | None = None) -> DataFrame:
    """Orders and revenue by day of week, Monday first."""
    per_day = (
        totals.where(since_key(since))
        .groupBy("date_key")
        .agg(
            F.sum("revenue").cast(MONEY).alias("revenue"),
            F.count("order_id").alias("orders"),
            F.sum("priced_lines").alias("lines"),
        )
    )
    days = dim_date.select(
        "date_key", "day_name", "is_weekend", (F.weekday("calendar_date") + 1).alias("day_of_week")
    )
    return (
        per_day.join(days, "date_key")
        .groupBy("day_of_week", "day_name", "is_weekend")
        .agg(
            F.sum("orders").alias("order_count"),
            _total("revenue").alias("total_revenue"),
            F.sum("lines").alias("lines"),
        )
        .withColumn("avg_transaction_value", F.try_divide("total_revenue", "lines"))
        .drop("lines")
        .orderBy("day_of_week")
    )


def key_to_date(key: Column | str) -> Column:
    return F.to_date(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), "yyyyMMdd")


def revenue_by_period(totals: DataFrame, period: str) -> DataFrame:
    """Revenue, orders, customers and the ratios between them per ``day``,
    ``week`` or ``month``."""
    start = F.to_date(F.date_trunc(period, key_to_date("date_key")))
    per_customer = (
        totals
        .groupBy(start.alias("period_start"), "customer_key")
        .agg(F.sum("revenue").cast(MONEY).alias("revenue"), F.count("order_id").alias("orders"))
    )
    by_period = per_customer.groupBy("period_start").agg(
        _total("revenue").alias("revenue"),
        F.sum("orders").alias("order_count"),
        F.count("customer_key").alias("customer_count"),
    )
    return by_period.withColumns(
        {
            "avg_order_value": F.try_divide("revenue", "order_count"),
            "revenue_per_customer": F.try_divide("revenue", "customer_count"),
        }
    )


def period_growth(totals: DataFrame, *group: str, periods: int = 1, unit: str = "month") -> DataFrame:
    """Change against an earlier period of ``revenue_by_period``-like rows.

    ``periods=1`` compares with the ``unit`` before, 12 on months or 52 on
    weeks with the year before.  A period is compared with the one that many
    units earlier; where that one has no rows, there is nothing to compare.
    """
    step = F.expr(f"interval {periods} {unit}")
    earlier = totals.select(
        (F.col("period_start") + step).cast("date").alias("later_start"),
        F.col("revenue").alias("previous_revenue"),
        *[F.col(name).alias(f"earlier_{name}") for name in group],
    )
    same = F.col("period_start") == F.col("later_start")
    for name in group:
        same = same & F.col(name).eqNullSafe(F.col(f"earlier_{name}"))
    before = F.col("previous_revenue")
    return totals.join(earlier, same, "left").select(
        *group,
        "period_start",
        "revenue",
        before,
        quotient(F.col("revenue") - before, before).alias("growth"),
    )


def revenue_by_category(sales: DataFrame, dim_products: DataFrame, period: str) -> DataFrame:
    """Revenue per product category and period, input of ``period_growth``."""
    start = F.to_date(F.date_trunc(period, key_to_date("date_key")))
    per_product = sales.groupBy(start.alias("period_start"), "product_key").agg(
        F.sum(F.col("sub_total").cast("decimal(18,4)")).cast(MONEY).alias("revenue")
    )
    catalogue = dim_products.select(F.col("product_id").alias("product_key"), "category")
    return (
        per_product.join(catalogue, "product_key")
        .groupBy("category", "period_start")
        .agg(_total("revenue").alias("revenue"))
    )


def order_profile(totals: DataFrame) -> DataFrame:
    """One row: items per order, discount total, mean unit price."""
    return (
        totals
        .agg(
            F.count("order_id").alias("order_count"),
            F.sum("lines").alias("line_count"),
            F.sum("units").alias("unit_count"),
            _total("discount").alias("total_discount"),
            _total("unit_prices").alias("unit_prices"),
        )
        .select(
            "order_count",
            "total_discount",
            F.try_divide("line_count", "order_count").alias("items_per_order"),
            F.try_divide("unit_count", "order_count").alias("units_per_order"),
            F.try_divide("unit_prices", "line_count").alias("avg_unit_price"),
        )
    )


def product_totals(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_key").agg(
        money_sum("sub_total").alias("total_sales_amt"), F.sum("quantity").alias("total_quantity_sold")
    )


def best_sellers(
    sales: DataFrame, dim_products: DataFrame, by: str = "total_sales_amt", limit: int = 20
) -> DataFrame:
    """Top products by ``total_sales_amt`` or ``total_quantity_sold``; ties by
    product id.  The limit is applied before the names are looked up."""
    top = product_totals(sales).orderBy(F.desc(by), "product_key").limit(limit)
    return top.join(
        dim_products.select(F.col("product_id").alias("product_key"), "product_name", "category", "brand_name"),
        "product_key",
        "left",
    ).orderBy(F.desc(by), "product_key")


def revenue_share(sales: DataFrame, dim_products: DataFrame, attribute: str) -> DataFrame:
    """Revenue of each brand or category and its share of the total."""
    per_product = sales.groupBy("product_key").agg(
        F.sum(F.col("sub_total").cast("decimal(18,4)")).cast(MONEY).alias("revenue")
    )
    catalogue = dim_products.select(F.col("product_id").alias("product_key"), attribute)
    exact = (
        per_product.join(catalogue, "product_key").groupBy(attribute).agg(F.sum("revenue").cast(MONEY).alias("revenue"))
    )
    total = exact.agg(_total("revenue")).scalar()
    return exact.select(
        attribute,
        F.col("revenue").cast("double").alias("revenue"),
        (F.col("revenue").cast("double") / total).alias("revenue_share"),
    )


def discount_impact(sales: DataFrame) -> DataFrame:
    """Lines, units and revenue at each discount level, in whole percent."""
    return (
        sales.groupBy(F.round(F.col("discount_percent") * 100).cast("int").alias("discount_pct"))
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum("quantity").alias("units"),
            money_sum("sub_total").alias("gross_revenue"),
            money_sum("discount_amt").alias("total_discount"),
        )
        .withColumn("units_per_line", F.try_divide("units", "line_count"))
    )


def customer_value(totals: DataFrame) -> DataFrame:
    """Lifetime value, orders and last order day per customer."""
    return (
        totals
        .groupBy("customer_key")
        .agg(
            _total("revenue").alias("lifetime_value"),
            F.count("order_id").alias("total_orders"),
            F.max("date_key").alias("last_date_key"),
        )
    )


def top_customers(totals: DataFrame, limit: int = 100) -> DataFrame:
    return customer_value(totals).orderBy(F.desc("lifetime_value"), "customer_key").limit(limit)


def repeat_rate(fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Share of buying customers with more than one order, by tier."""
    buyers = fact_orders.groupBy("customer_key").agg(F.count("order_id").alias("orders"))
    return (
        buyers.join(dim_customers, buyers.customer_key == dim_customers.customer_id)
        .groupBy("tier")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum(flag(F.col("orders") > 1)).alias("repeat_customers"),
        )
        .withColumn("repeat_purchase_rate", F.try_divide("repeat_customers", "customers"))
    )


def retention(fact_orders: DataFrame, period: str = "month") -> DataFrame:
    """Of the customers who bought in one period, the share that bought in the
    next one.

    Works on distinct (customer, period) pairs: each pair also votes for the
    following period, and a customer is retained where both votes meet.  One
    aggregation replaces a self join.
    """
    step = F.expr(f"interval 1 {period}")
    start = F.to_date(F.date_trunc(period, key_to_date("date_key")))
    bought = fact_orders.select("customer_key", start.alias("period_start")).distinct()
    votes = bought.select(
        "customer_key",
        F.explode(
            F.array(
                F.struct(F.col("period_start"), F.lit(1).alias("now"), F.lit(0).alias("before")),
                F.struct(
                    (F.col("period_start") + step).cast("date").alias("period_start"),
                    F.lit(0).alias("now"),
                    F.lit(1).alias("before"),
                ),
            )
        ).alias("vote"),
    ).select("customer_key", "vote.*")
    met = votes.groupBy("customer_key", "period_start").agg(
        F.max("now").alias("now"), F.max("before").alias("before")
    )
    return (
        met.groupBy("period_start")
        .agg(
            F.sum("before").alias("previous_customers"),
            F.sum(F.col("now") * F.col("before")).alias("retained_customers"),
            F.max("now").alias("seen"),
        )
        # Nothing is known of the period after the last one with orders.
        .withColumn("last_seen", F.max(F.when(F.col("seen") == 1, F.col("period_start"))).over(Window.partitionBy()))
        .where((F.col("previous_customers") > 0) & (F.col("period_start") <= F.col("last_seen")))
        .drop("seen", "last_seen")
        .withColumn("retention_rate", F.try_divide("retained_customers", "previous_customers"))
    )


def churn_by_tier(
    fact_orders: DataFrame, dim_customers: DataFrame, as_of: dt.date | str, days: int = 90
) -> DataFrame:
    """Share of buying customers without an order in the last ``days`` days."""
    last = fact_orders.groupBy("customer_key").agg(F.max("date_key").alias("last_date_key"))
    limit = date_key(F.date_sub(F.lit(as_of).cast("date"), days))
    return (
        last.join(dim_customers, last.customer_key == dim_customers.customer_id)
        .groupBy("tier")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum(flag(F.col("last_date_key") < limit)).alias("churned_customers"),
        )
        .withColumn("churn_rate", F.try_divide("churned_customers", "customers"))
    )
