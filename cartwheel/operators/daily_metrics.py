"""Per user and day totals, and the three-active-day features built on them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.scalars import flag, money_avg, money_sum, ratio

# Counts taken from the action flags, and the measures of a user-day.
ACTION_COUNTS = {
    "view_count": "is_view",
    "add_to_cart_count": "is_add_to_cart",
    "purchase_count": "is_purchase",
    "search_count": "is_search",
    "wishlist_count": "is_wishlist",
    "checkout_view_count": "is_checkout_view",
}
SESSION_MEASURES = {
    "sessions_count": 0,
    "total_duration": 0,
    "avg_duration": 0.0,
    "total_page_views": 0,
    "total_actions": 0,
    "purchase_sessions_count": 0,
    "total_revenue": 0.0,
    "has_purchase_today": 0,
}
# The action columns ``actions_daily`` reads besides the flags.
DAILY_ACTION_COLUMNS = ("product_id", "product_price", "revenue")
ACTION_MEASURES = {**dict.fromkeys(ACTION_COUNTS, 0), "distinct_products_viewed": 0, "avg_product_price": 0.0}


def _since(column: Column, since: dt.date | str | None) -> Column:
    return F.lit(True) if since is None else column >= F.lit(since).cast("date")


def sessions_daily(user_sessions: DataFrame, since: dt.date | str | None = None) -> DataFrame:
    """Session totals by user and day of the session start."""
    day = F.col("timestamp").cast("date")
    bought = flag(F.col("has_purchase"))
    return (
        user_sessions.where(_since(day, since))
        .groupBy("user_id", day.alias("session_date"))
        .agg(
            F.count_distinct("session_id").alias("sessions_count"),
            F.sum("duration_seconds").alias("total_duration"),
            F.avg("duration_seconds").alias("avg_duration"),
            F.sum("page_views").alias("total_page_views"),
            F.sum("actions_count").alias("total_actions"),
            F.sum(bought).alias("purchase_sessions_count"),
            F.sum(F.col("revenue").cast("double")).alias("total_revenue"),
            F.max(bought).alias("has_purchase_today"),
        )
    )


def actions_daily(
    session_actions: DataFrame,
    user_sessions: DataFrame | None = None,
    since: dt.date | str | None = None,
) -> DataFrame:
    """Action totals by user and day of the action.

    The user comes from ``user_sessions``; leave it out when the actions
    already carry ``user_id``.
    """
    rows = session_actions
    if user_sessions is not None:
        rows = rows.join(user_sessions.select("session_id", "user_id"), "session_id")
    day = F.col("action_timestamp").cast("date")
    return (
        rows.where(_since(day, since))
        .groupBy("user_id", day.alias("action_date"))
        .agg(
            *[F.sum(source).alias(name) for name, source in ACTION_COUNTS.items()],
            F.count_distinct("product_id").alias("distinct_products_viewed"),
            money_avg("product_price").alias("avg_product_price"),
            money_sum("revenue").alias("action_revenue"),
        )
    )


def user_daily_metric(sessions: DataFrame, actions: DataFrame) -> DataFrame:
    """Full outer join of the two daily tables, missing measures filled with 0.

    Days can differ when a session crosses midnight: such a day has actions
    and no session.  NULL users never match, so a date with anonymous traffic
    gives two rows.  Both inputs arrive partitioned on the join keys, so the
    join itself adds no shuffle.
    """
    left = sessions.withColumnRenamed("session_date", "activity_date").alias("s")
    right = actions.withColumnRenamed("action_date", "activity_date").alias("a")
    joined = left.join(
        right,
        (F.col("s.user_id") == F.col("a.user_id"))
        & (F.col("s.activity_date") == F.col("a.activity_date")),
        "full",
    )
    return joined.select(
        F.coalesce("s.user_id", "a.user_id").alias("user_id"),
        F.coalesce("s.activity_date", "a.activity_date").alias("activity_date"),
        *[F.coalesce(f"s.{name}", F.lit(zero)).alias(name) for name, zero in SESSION_MEASURES.items()],
        *[F.coalesce(f"a.{name}", F.lit(zero)).alias(name) for name, zero in ACTION_MEASURES.items()],
    )


# Output name of each trailing sum and the measure it adds up.
TRAILING_SUMS = {
    "sessions_3d": "sessions_count",
    "total_duration_3d": "total_duration",
    "total_page_views_3d": "total_page_views",
    "total_actions_3d": "total_actions",
    "purchase_sessions_3d": "purchase_sessions_count",
    "total_revenue_3d": "total_revenue",
    "view_count_3d": "view_count",
    "add_to_cart_count_3d": "add_to_cart_count",
    "purchase_count_3d": "purchase_count",
    "search_count_3d": "search_count",
    "wishlist_count_3d": "wishlist_count",
    "checkout_view_count_3d": "checkout_view_count",
    "distinct_products_3d": "distinct_products_viewed",
}
# Derived rate -> (numerator, denominator), both trailing sums.
TRAILING_RATES = {
    "avg_session_duration_3d": ("total_duration_3d", "sessions_3d"),
    "cart_conversion_rate_3d": ("add_to_cart_count_3d", "view_count_3d"),
    "purchase_conversion_rate_3d": ("purchase_count_3d", "add_to_cart_count_3d"),
    "actions_per_session_3d": ("total_actions_3d", "sessions_3d"),
    "purchase_session_rate_3d": ("purchase_sessions_3d", "sessions_3d"),
}


def user_behavior_features(
    daily: DataFrame,
    days: int = 3,
    include_anonymous: bool = False,
    unknown_label: int | None = 0,
) -> DataFrame:
    """Features over each user's previous ``days`` active days, and the label
    "buys on the next calendar day".

    The window holds one row per user and day, so its largest partition is
    bounded by the number of days, however hot the user.  Rows without earlier
    sessions are dropped.  ``unknown_label`` is the label of a user's last
    active day; ``None`` marks it unknown.  Anonymous rows share one NULL
    user, so they say nothing about a person and are left out by default;
    with them, the two rows of a date are ordered by their session count.
    """
    rows = daily if include_anonymous else daily.where(F.col("user_id").isNotNull())
    ordered = Window.partitionBy("user_id").orderBy("activity_date", "sessions_count")
    trailing = ordered.rowsBetween(-days, -1)
    following = F.lead("activity_date").over(ordered)
    bought_next = F.lead("has_purchase_today").over(ordered)
    label = F.when(following == F.date_add("activity_date", 1), bought_next).otherwise(0)
    if unknown_label != 0:
        label = F.when(following.isNull(), F.lit(unknown_label).cast("int")).otherwise(label)

    day = F.col("activity_date")
    windowed = rows.select(
        "user_id",
        day.alias("prediction_date"),
        F.year(day).alias("prediction_year"),
        F.month(day).alias("prediction_month"),
        label.alias("label_purchase_tomorrow"),
        *[F.sum(source).over(trailing).alias(name) for name, source in TRAILING_SUMS.items()],
        F.avg("avg_product_price").over(trailing).alias("avg_product_price_3d"),
    )
    return windowed.where(F.col("sessions_3d") > 0).withColumns(
        {name: ratio(F.col(top), F.col(bottom)) for name, (top, bottom) in TRAILING_RATES.items()}
    )
