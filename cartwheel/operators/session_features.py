"""Per-session features for "does this session end in a purchase"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scalars import flag, money_avg, ratio
from cartwheel.operators.activity import session_columns
from cartwheel.operators.ranking import exact_quantiles

# Feature name -> action type it counts.
TYPE_COUNTS = {
    "num_views": "view",
    "num_add_to_cart": "add_to_cart",
    "num_wishlist": "wishlist",
    "num_searches": "search",
    "num_reviews": "review",
    "num_remove_from_cart": "remove_from_cart",
}


def session_base(sessions: DataFrame, *keep: str) -> DataFrame:
    """Session columns plus hour of day and weekend flag; ``keep`` names more
    columns to pass on."""
    return sessions.select(
        "session_id", "user_id", "duration_seconds", "page_views", "device_type", "actions_count",
        "has_purchase", "user_segment", "referrer_type", "year", "month", "day",
        F.hour("timestamp").alias("hour_of_day"),
        flag(F.dayofweek("timestamp").isin(1, 7)).alias("is_weekend"),
        *keep,
    )


def action_features(actions: DataFrame) -> DataFrame:
    """All action features in one pass over the exploded actions."""
    return actions.groupBy("session_id").agg(
        *[F.sum(f"is_{kind}").alias(name) for name, kind in TYPE_COUNTS.items()],
        F.max("is_checkout_view").alias("has_checkout_view"),
        F.count_distinct("product_id").alias("unique_products_viewed"),
        F.count_distinct("product_category").alias("unique_categories_viewed"),
        money_avg("product_price").alias("avg_product_price"),
        F.max("product_price").alias("max_price_viewed"),
        F.min("product_price").alias("min_price_viewed"),
    )


def _finish(rows: DataFrame) -> DataFrame:
    """Derived columns over session and action features in one row."""

    def count(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    def price(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0))

    duration, pages = F.col("duration_seconds"), F.col("page_views")
    per_page = F.when((duration > 0) & (pages > 0), duration.cast("double") / pages).otherwise(0.0)
    plain_counts = [*TYPE_COUNTS, "has_checkout_view", "unique_products_viewed", "unique_categories_viewed"]
    return rows.select(
        "session_id",
        "user_id",
        F.col("has_purchase").alias("label"),
        "duration_seconds",
        "actions_count",
        "page_views",
        ratio(F.col("actions_count").cast("double"), duration).alias("action_velocity"),
        per_page.alias("avg_time_per_page"),
        *[count(name).alias(name) for name in plain_counts],
        flag(count("num_searches") > 0).alias("has_search"),
        flag(count("num_remove_from_cart") > 0).alias("has_cart_removal"),
        ratio(count("num_add_to_cart").cast("double"), F.col("num_views")).alias("cart_conversion_rate"),
        price("avg_product_price").alias("avg_product_price"),
        (price("max_price_viewed") - price("min_price_viewed")).alias("price_range_interest"),
        price("max_price_viewed").alias("max_price_viewed"),
        price("min_price_viewed").alias("min_price_viewed"),
        "hour_of_day",
        "is_weekend",
        flag(F.col("device_type") == "mobile").alias("is_mobile"),
        "user_segment",
        "referrer_type",
        "year", "month", "day",
    )


def session_features(sessions: DataFrame, actions: DataFrame) -> DataFrame:
    """Features from the two silver tables; sessions without actions keep 0s."""
    return _finish(session_base(sessions).join(action_features(actions), "session_id", "left"))


def session_features_from_logs(logs: DataFrame) -> DataFrame:
    """The same features straight from the nested records.

    A record holds all actions of its session, so array functions replace the
    explode, the aggregation and the join: no shuffle at all.
    """

    def values(field: str) -> Column:
        """The field of all actions; reads no other field."""
        return F.coalesce(F.col(f"actions.{field}"), F.array())

    def count_of(kind: str) -> Column:
        others = F.array_remove(values("type"), kind)
        return (F.size(values("type")) - F.size(others)).cast("bigint")

    def distinct_of(field: str) -> Column:
        return F.size(F.array_compact(F.array_distinct(values(field)))).cast("bigint")

    prices = values("price")
    total = F.aggregate(
        F.array_compact(prices), F.lit(0).cast("decimal(28,4)"),
        lambda acc, p: (acc + p.cast("decimal(18,4)")).cast("decimal(28,4)"),
    )
    pages = F.arrays_zip(values("type").alias("type"), values("page").alias("page"))
    checkout = F.struct(F.lit("view").alias("type"), F.lit("/checkout").alias("page"))
    nested = {
        **{name: count_of(kind) for name, kind in TYPE_COUNTS.items()},
        "has_checkout_view": flag(F.array_contains(pages, checkout)),
        "unique_products_viewed": distinct_of("product_id"),
        "unique_categories_viewed": distinct_of("category"),
        "avg_product_price": F.try_divide(total.cast("double"), F.size(F.array_compact(prices))),
        "max_price_viewed": F.array_max(prices),
        "min_price_viewed": F.array_min(prices),
    }
    sessions = logs.select(*session_columns(), *[value.alias(name) for name, value in nested.items()])
    return _finish(session_base(sessions, *nested))


def conversion_by(features: DataFrame, *keys: str) -> DataFrame:
    """Sessions, conversion rate and mean duration per group.

    ``reached_cart`` and ``reached_checkout`` may be used as keys.
    """
    bought = flag(F.col("label"))
    flagged = features.withColumns(
        {
            "reached_cart": flag(F.col("num_add_to_cart") > 0),
            "reached_checkout": flag(F.col("has_checkout_view") > 0),
        }
    )
    return flagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.avg(bought).alias("conversion_rate"),
        F.avg("duration_seconds").alias("avg_duration"),
    ).orderBy(F.desc("conversion_rate"), *keys)


def label_counts(features: DataFrame, label: str = "label") -> DataFrame:
    return features.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))


def feature_profile(features: DataFrame) -> DataFrame:
    """One row of means over all sessions."""
    return features.agg(
        F.avg("duration_seconds").alias("avg_duration"),
        F.avg("page_views").alias("avg_page_views"),
        F.avg("num_add_to_cart").alias("avg_cart_adds"),
        F.avg("unique_products_viewed").alias("avg_products"),
        F.avg(flag(F.col("label"))).alias("purchase_rate"),
        F.avg("action_velocity").alias("avg_action_velocity"),
        F.avg("cart_conversion_rate").alias("avg_cart_conversion"),
    )


def time_to_first_action(logs: DataFrame) -> DataFrame:
    """Smallest action offset of each session, NULL when it has no action."""
    return logs.select("session_id", F.array_min("actions.time_offset").alias("time_to_first_action"))


def hour_bucket(hour: Column | str) -> Column:
    """Part of the day: night before 6, morning before 12, afternoon before
    18, evening after that."""
    hour = F.col(hour) if isinstance(hour, str) else hour
    return (
        F.when(hour < 6, "night").when(hour < 12, "morning").when(hour < 18, "afternoon").otherwise("evening")
    )


def with_interactions(features: DataFrame) -> DataFrame:
    """Adds the hour bucket, cart-by-mobile and squared duration terms."""
    duration = F.col("duration_seconds").cast("double")
    return features.withColumns(
        {
            "time_of_day_bucket": hour_bucket("hour_of_day"),
            "cart_adds_on_mobile": F.col("num_add_to_cart") * F.col("is_mobile"),
            "duration_squared": duration * duration,
        }
    )


def winsorised(features: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Clamps a column to its own quantiles.

    The two bounds are exact (``ranking.exact_quantiles``) and the only values
    the driver compares with every row.  NULL and NaN stay as they are.
    """
    least, most = exact_quantiles(features, column, [low, high])
    if least is None:
        return features
    value = F.col(column).cast("double")
    clamped = F.greatest(F.least(value, F.lit(most)), F.lit(least))
    return features.withColumn(column, F.when(value.isNull() | F.isnan(value), value).otherwise(clamped))
