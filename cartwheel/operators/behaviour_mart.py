"""Behaviour fact (one row per action) and its daily channel totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scalars import as_stamp, percent
from cartwheel.operators.activity import exploded, row_key, type_flags


#: Tasks over which actions without a product are spread.
NULL_SALTS = 4096


def behaviour_rows(logs: DataFrame) -> DataFrame:
    """Actions with session context: the fact without its dimension keys, for
    reports that need none.  One pass over the records, no shuffle."""
    started = as_stamp("timestamp")
    return exploded(
        logs, ("type", "product_id", "search_term", "order_id", "total_amount"),
        "event_id", "session_id", "user_id", "timestamp", "device", "location",
        "source", "campaign", "session_metrics", "ingest_date",
    ).select(
        row_key("event_id").alias("behavior_id"),
        "event_id",
        "user_id",
        "session_id",
        started.cast("date").alias("action_date"),
        started.alias("action_timestamp"),
        F.col("action.type").alias("action_type"),
        F.col("action.product_id").alias("product_id"),
        F.col("action.search_term").alias("search_term"),
        F.col("action.order_id").alias("order_id"),
        F.col("action.total_amount").alias("revenue"),
        F.col("session_metrics.duration_seconds").alias("session_duration"),
        F.col("session_metrics.page_views").alias("session_page_views"),
        F.col("device.type").alias("device_type"),
        F.col("device.os").alias("device_os"),
        "location.city",
        "location.country",
        F.col("location.coordinates.lat").alias("latitude"),
        F.col("location.coordinates.lon").alias("longitude"),
        F.coalesce("source", F.lit("direct")).alias("traffic_source"),
        F.col("campaign").alias("utm_campaign"),
        *type_flags("view", "add_to_cart", "purchase", "search"),
        "ingest_date",
    )


def fact_user_behavior(
    logs: DataFrame, dim_products: DataFrame, dim_date: DataFrame, null_salts: int = NULL_SALTS
) -> DataFrame:
    """Actions with session context and the keys of the matching dimensions.

    A dimension with an ``is_current`` column is cut to its current rows.

    Actions without a product (searches, checkout pages) are a large group
    that matches nothing.  The salt spreads them over ``null_salts`` tasks; a
    hot product is split by the adaptive skew join.
    """
    catalogue = dim_products
    if "is_current" in catalogue.columns:
        catalogue = catalogue.where("is_current")
    # Always 0, but not as a literal: the optimiser would turn a literal into a
    # filter and partition on the product alone again.
    zero = F.pmod(F.col("product_id"), F.lit(1)).cast("bigint").alias("salt")
    catalogue = catalogue.select("product_id", F.col("product_id").alias("product_key"), zero)
    days = dim_date.select(F.col("calendar_date").alias("action_date"), F.col("date_key").alias("date_key"))

    rows = behaviour_rows(logs)
    spread = F.pmod(F.xxhash64("behavior_id"), F.lit(null_salts))
    salted = rows.withColumn("salt", F.when(F.col("product_id").isNull(), spread).otherwise(F.lit(0).cast("bigint")))
    return (
        salted.join(catalogue, ["product_id", "salt"], "left").drop("salt").join(days, "action_date", "left")
    )


def fact_daily_metrics(behavior: DataFrame) -> DataFrame:
    """Exact distinct users and sessions, action totals and ratios per day,
    traffic source and device.  Takes ``behaviour_rows`` or the fact.

    Spark copies each input row once per distinct count.  Here actions are
    rolled up to sessions and, apart from that, to users; rows of each are
    then counted, and the two small results meet by a join.  Most of both
    roll-ups happens on the map side, where a session's actions lie together.
    """
    keys = ["metric_date", "traffic_source", "device_type"]
    rows = behavior.withColumnRenamed("action_date", "metric_date")
    bought = F.col("is_purchase") == 1
    earned = F.when(bought, F.col("revenue")).otherwise(0.0).cast("decimal(18,4)")
    per_session = rows.groupBy(*keys, "session_id").agg(
        F.sum("is_view").alias("views"),
        F.sum("is_search").alias("searches"),
        F.sum("is_add_to_cart").alias("carts"),
        F.sum("is_purchase").alias("purchases"),
        F.sum(earned).cast("decimal(28,4)").alias("revenue"),
        F.sum("session_duration").alias("duration"),
        F.count("session_duration").alias("duration_rows"),
        F.sum("session_page_views").alias("pages"),
        F.count("session_page_views").alias("page_rows"),
    )
    totals = per_session.groupBy(*keys).agg(
        F.count("session_id").alias("total_sessions"),
        F.sum("views").alias("total_views"),
        F.sum("searches").alias("total_searches"),
        F.sum("carts").alias("total_add_to_carts"),
        F.sum("purchases").alias("total_purchases"),
        F.sum("revenue").cast("double").alias("total_revenue"),
        F.try_divide(F.sum("duration"), F.sum("duration_rows")).alias("avg_session_duration"),
        F.try_divide(F.sum("pages"), F.sum("page_rows")).alias("avg_page_views"),
        F.count(F.when(F.col("purchases") > 0, F.col("session_id"))).alias("converted_sessions"),
    )
    users = rows.select(*keys, "user_id").distinct().groupBy(*keys).agg(F.count("user_id").alias("active_users"))
    same = [totals[c].eqNullSafe(users[c]) for c in keys]
    daily = totals.join(users, same).select(*[totals[c] for c in totals.columns], "active_users")
    return daily.withColumns(
        {
            "conversion_rate_pct": percent(F.col("converted_sessions"), F.col("total_sessions")),
            "avg_order_value": F.round(F.try_divide("total_revenue", "total_purchases"), 2),
        }
    )
