"""Reports over the behaviour fact and its daily totals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scalars import flag, money_sum, percent, quotient
from cartwheel.operators.activity import exploded


def _since(column: str, since: dt.date | str | None) -> Column:
    return F.lit(True) if since is None else F.col(column) >= F.lit(since).cast("date")


def funnel(behavior: DataFrame, since: dt.date | str | None = None) -> DataFrame:
    """View, cart and purchase counts by day with the rates between them."""
    daily = (
        behavior.where(_since("action_date", since))
        .groupBy("action_date")
        .agg(
            F.sum("is_view").alias("total_views"),
            F.sum("is_add_to_cart").alias("total_add_to_carts"),
            F.sum("is_purchase").alias("total_purchases"),
        )
    )
    views, carts, bought = F.col("total_views"), F.col("total_add_to_carts"), F.col("total_purchases")
    return daily.withColumns(
        {
            "view_to_cart_pct": percent(carts, views),
            "cart_to_purchase_pct": percent(bought, carts),
            "overall_conversion_pct": percent(bought, views),
        }
    ).orderBy(F.desc("action_date"))


def channel_performance(daily_metrics: DataFrame, since: dt.date | str | None = None) -> DataFrame:
    """Totals per traffic source and device over ``fact_daily_metrics``."""

    def mean(column: str) -> Column:
        return F.try_divide(money_sum(column), F.count(column))

    return (
        daily_metrics.where(_since("metric_date", since))
        .groupBy("traffic_source", "device_type")
        .agg(
            F.sum("active_users").alias("total_users"),
            F.sum("total_sessions").alias("sessions"),
            F.sum("total_purchases").alias("purchases"),
            money_sum("total_revenue").alias("revenue"),
            mean("conversion_rate_pct").alias("avg_conversion_rate"),
            mean("avg_order_value").alias("avg_order_value"),
        )
        .withColumn("revenue_per_user", F.try_divide("revenue", "total_users"))
        .orderBy(F.desc("revenue"), "traffic_source", "device_type")
    )


def _product_counts(behavior: DataFrame) -> DataFrame:
    bought = F.col("is_purchase") == 1
    return behavior.where(F.col("product_key").isNotNull()).groupBy("product_key").agg(
        F.sum("is_view").alias("views"),
        F.sum("is_add_to_cart").alias("add_to_carts"),
        F.sum("is_purchase").alias("purchases"),
        F.sum(F.when(bought, F.col("revenue")).otherwise(0.0).cast("decimal(18,4)"))
        .cast("decimal(28,4)")
        .alias("revenue"),
    )


def product_engagement(
    behavior: DataFrame,
    dim_products: DataFrame,
    since: dt.date | str | None = None,
    min_views: int = 100,
    limit: int | None = 20,
) -> DataFrame:
    """Most viewed products, worst cart-to-purchase rate first among equals.

    Actions are counted per product before the names are joined.
    """
    counts = _product_counts(behavior.where(_since("action_date", since)))
    names = dim_products.select(
        F.col("product_id").alias("product_key"), "product_name", "category", "brand_name"
    )
    keys = ["product_name", "category", "brand_name"]
    named = (
        counts.join(names, "product_key")
        .groupBy(*keys)
        .agg(
            F.sum("views").alias("views"),
            F.sum("add_to_carts").alias("add_to_carts"),
            F.sum("purchases").alias("purchases"),
            F.sum("revenue").cast("double").alias("total_revenue"),
        )
        .where(F.col("views") >= min_views)
        .withColumns(
            {
                "view_to_cart_rate": percent(F.col("add_to_carts"), F.col("views")),
                "cart_to_purchase_rate": percent(F.col("purchases"), F.col("add_to_carts")),
            }
        )
    )
    ordered = named.orderBy(F.desc("views"), "cart_to_purchase_rate", *keys)
    return ordered if limit is None else ordered.limit(limit)


def product_kpis(behavior: DataFrame) -> DataFrame:
    """Views, add-to-cart rate and conversion per product."""
    counts = _product_counts(behavior)
    return counts.select(
        "product_key",
        "views",
        "add_to_carts",
        "purchases",
        percent(F.col("add_to_carts"), F.col("views")).alias("add_to_cart_rate"),
        percent(F.col("purchases"), F.col("views")).alias("conversion_rate"),
    )


def viewed_not_bought(behavior: DataFrame, min_views: int, max_conversion_pct: float) -> DataFrame:
    """Products with many views and few purchases."""
    return product_kpis(behavior).where(
        (F.col("views") >= min_views) & (F.col("conversion_rate") <= max_conversion_pct)
    )


def conversion_kpis(daily_metrics: DataFrame) -> DataFrame:
    """Conversion, cart and abandonment rates and revenue per session by day.

    Sessions are added up over source and device, as the stored totals are.
    """
    daily = daily_metrics.groupBy("metric_date").agg(
        F.sum("total_sessions").alias("sessions"),
        F.sum("total_views").alias("views"),
        F.sum("total_add_to_carts").alias("carts"),
        F.sum("total_purchases").alias("purchases"),
        money_sum("total_revenue").alias("revenue"),
    )
    sessions, views, carts, bought = (F.col(c) for c in ("sessions", "views", "carts", "purchases"))
    return daily.select(
        "metric_date",
        percent(bought, sessions).alias("conversion_rate"),
        percent(carts, views).alias("view_to_cart_rate"),
        percent(bought, carts).alias("cart_to_purchase_rate"),
        F.try_divide(10000 - percent(bought, carts) * 100, F.lit(100.0)).alias("abandonment_rate"),
        F.try_divide("revenue", "purchases").alias("avg_order_value"),
        F.try_divide("revenue", "sessions").alias("revenue_per_session"),
    )


def engagement_kpis(sessions: DataFrame) -> DataFrame:
    """Active users, mean duration and pages, bounce rate by day.

    A bounce is a session with a single action.  Takes ``user_sessions``.
    """
    day = F.col("timestamp").cast("date")
    return sessions.groupBy(day.alias("session_date")).agg(
        F.count_distinct("user_id").alias("daily_active_users"),
        F.count(F.lit(1)).alias("sessions"),
        F.avg("duration_seconds").alias("avg_session_duration"),
        F.avg("page_views").alias("pages_per_session"),
        F.avg(flag(F.col("actions_count") == 1)).alias("bounce_rate"),
    )


def active_users(sessions: DataFrame, period: str) -> DataFrame:
    """Distinct users per ``day``, ``week`` or ``month``."""
    start = F.to_date(F.date_trunc(period, "timestamp"))
    return sessions.groupBy(start.alias("period_start")).agg(
        F.count_distinct("user_id").alias("active_users")
    )


def source_performance(daily_metrics: DataFrame) -> DataFrame:
    """Revenue and conversion per traffic source."""
    return (
        daily_metrics.groupBy("traffic_source")
        .agg(
            money_sum("total_revenue").alias("revenue"),
            F.sum("total_sessions").alias("sessions"),
            F.sum("converted_sessions").alias("converted_sessions"),
        )
        .withColumn("conversion_rate", percent(F.col("converted_sessions"), F.col("sessions")))
    )


def campaign_performance(behavior: DataFrame) -> DataFrame:
    """Sessions, buyers' sessions and revenue per campaign.

    Rolling up to sessions first turns both distinct counts into plain ones.
    """
    earned = F.when(F.col("is_purchase") == 1, F.col("revenue")).otherwise(0.0)
    per_session = (
        behavior.where(F.col("utm_campaign").isNotNull())
        .groupBy("utm_campaign", "session_id")
        .agg(
            F.max("is_purchase").alias("converted"),
            F.sum(earned.cast("decimal(18,4)")).cast("decimal(28,4)").alias("revenue"),
        )
    )
    return (
        per_session.groupBy("utm_campaign")
        .agg(
            F.count("session_id").alias("sessions"),
            F.sum("converted").alias("converted_sessions"),
            F.sum("revenue").cast("double").alias("revenue"),
        )
        .withColumn("conversion_rate", percent(F.col("converted_sessions"), F.col("sessions")))
    )


def marketing_cost(daily_metrics: DataFrame, spend: DataFrame, new_customers: DataFrame | None = None) -> DataFrame:
    """Cost per acquisition and return on spend per channel.

    ``spend`` has channel, date and amount.  ``new_customers`` (channel,
    new_customers) adds the acquisition cost; without it that column is NULL.
    """
    costs = spend.groupBy(F.col("channel").alias("traffic_source")).agg(money_sum("amount").alias("spend"))
    earned = source_performance(daily_metrics).select("traffic_source", "revenue", "converted_sessions")
    rows = costs.join(earned, "traffic_source", "left")
    if new_customers is None:
        rows = rows.withColumn("new_customers", F.lit(None).cast("bigint"))
    else:
        rows = rows.join(new_customers.withColumnRenamed("channel", "traffic_source"), "traffic_source", "left")
    return rows.select(
        "traffic_source",
        "spend",
        quotient(F.col("spend"), F.col("new_customers")).alias("cac"),
        quotient(F.col("spend"), F.col("converted_sessions")).alias("cpa"),
        quotient(F.col("revenue"), F.col("spend")).alias("roas"),
    )


def search_terms(logs: DataFrame) -> DataFrame:
    """Searches per term, and how many of them found nothing."""
    rows = exploded(logs, ("type", "search_term", "results_count")).where(F.col("action.type") == "search")
    return rows.groupBy(F.col("action.search_term").alias("search_term")).agg(
        F.count(F.lit(1)).alias("searches"),
        F.sum(flag(F.col("action.results_count") == 0)).alias("searches_without_results"),
    )
