"""Marketing target lists built from predictions."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scalars import as_col, date_key, flag, ymd
from cartwheel.operators.predictions import on_day, positive_predictions
from cartwheel.operators.sales_reports import key_to_date

# Lowest probability of each segment, its name and its action.
SEGMENTS = (
    (0.80, "Hot Lead", "Send Premium Offer"),
    (0.60, "Warm Lead", "Send Discount Code"),
    (0.50, "Cold Lead", "Send General Newsletter"),
)


def banded(value: Column, bands: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first band whose lower limit the value reaches."""
    out = F
    for limit, label in bands:
        out = out.when(value >= limit, label)
    return out.otherwise(otherwise)


def contactable(customers: DataFrame) -> DataFrame:
    return customers.where(F.col("email").isNotNull())


def high_value_campaign(
    predictions: DataFrame,
    customers: DataFrame,
    campaign_date: dt.date | str,
    run_ts: dt.datetime | Column | None = None,
) -> DataFrame:
    """Likely buyers of a day with segment, action and contact data.

    Customers without an email address are left out, so the join is inner.
    Rows carry no order; sort by probability when reading (``hot_leads``).
    """
    floor, cold, newsletter = SEGMENTS[-1]
    upper = SEGMENTS[:-1]
    probability = F.col("purchase_probability")
    targets = positive_predictions(predictions, campaign_date, floor)
    contacts = contactable(customers).select(
        "customer_id", "first_name", "last_name", "email", F.col("phone_number").alias("phone")
    )
    stamp = F.current_timestamp() if run_ts is None else (run_ts if isinstance(run_ts, Column) else F.lit(run_ts))
    return targets.join(contacts, "customer_id").select(
        "customer_id",
        F.col("prediction_date").alias("campaign_date"),
        "purchase_probability",
        banded(probability, [(limit, name) for limit, name, _ in upper], cold).alias("customer_segment"),
        banded(probability, [(limit, act) for limit, _, act in upper], newsletter).alias("campaign_action"),
        "first_name", "last_name", "email", "phone",
        *ymd("prediction_date"),
        "predicted_at",
        stamp.cast("timestamp").alias("created_at"),
    )


def hot_leads(campaign: DataFrame, segment: str = "Hot Lead", limit: int = 100) -> DataFrame:
    """Most likely buyers of a segment; ties by customer."""
    return (
        campaign.where(F.col("customer_segment") == segment)
        .orderBy(F.desc("purchase_probability"), "customer_id")
        .limit(limit)
    )


def campaign_scores(
    campaign: DataFrame,
    features: DataFrame,
    fact_orders: DataFrame,
    probability_weight: float = 60.0,
    engagement_weight: float = 25.0,
    recency_weight: float = 15.0,
    full_engagement_sessions: int = 10,
    recency_days: int = 90,
    clv_horizon: float = 1.0,
) -> DataFrame:
    """Priority score 0-100, 30-day orders and spend, estimated lifetime value
    and contact channel for the rows of a campaign.

    The score formula is ours, so each of its weights is a parameter.
    Orders are counted up to the campaign date.
    """
    keyed = campaign.select(
        F.col("customer_id").alias("customer_key"), date_key("campaign_date").alias("campaign_key"),
        "campaign_date",
    )
    # Sum per customer and day first: at most one row per day meets the join.
    per_day = fact_orders.groupBy("customer_key", "date_key").agg(
        F.count("order_id").alias("orders"),
        F.sum(F.col("total_amount").cast("decimal(18,4)")).cast("decimal(28,4)").alias("spent"),
    )
    age = F.date_diff("campaign_date", key_to_date("date_key"))
    history = (
        keyed.join(per_day, "customer_key")
        .where(F.col("date_key") <= F.col("campaign_key"))
        .groupBy("customer_key", "campaign_date")
        .agg(
            F.sum(F.when(age <= 30, F.col("orders")).otherwise(0)).alias("orders_count_30d"),
            F.sum(F.when(age <= 30, F.col("spent"))).cast("double").alias("total_spent_30d"),
            F.sum("spent").cast("double").alias("spent_ever"),
            F.min(age).alias("days_since_last_purchase"),
        )
        .withColumnRenamed("customer_key", "customer_id")
    )
    active = features.select(
        F.col("user_id").alias("customer_id"),
        F.col("prediction_date").alias("campaign_date"),
        F.col("sessions_3d").alias("total_sessions_3d"),
    )
    engagement = F.least(F.coalesce("total_sessions_3d", F.lit(0)) / full_engagement_sessions, F.lit(1.0))
    recency = F.greatest(
        1 - F.coalesce("days_since_last_purchase", F.lit(recency_days)) / recency_days, F.lit(0.0)
    )
    score = (
        F.col("purchase_probability") * probability_weight
        + engagement * engagement_weight
        + recency * recency_weight
    )
    keys = ["customer_id", "campaign_date"]
    return (
        campaign.join(history, keys, "left")
        .join(active, keys, "left")
        .withColumns(
            {
                "engagement_score": engagement,
                "campaign_priority_score": F.least(F.greatest(score, F.lit(0.0)), F.lit(100.0)),
                "estimated_clv": F.coalesce("spent_ever", F.lit(0.0))
                + F.col("purchase_probability") * clv_horizon * F.coalesce("total_spent_30d", F.lit(0.0)),
                "primary_contact_channel": F.when(F.col("email").isNotNull(), "Email")
                .when(F.col("phone").isNotNull(), "SMS")
                .otherwise("In-App"),
                "orders_count_30d": F.coalesce("orders_count_30d", F.lit(0)),
                "total_spent_30d": F.coalesce("total_spent_30d", F.lit(0.0)),
            }
        )
        .drop("spent_ever")
    )


@dataclass(frozen=True)
class CartRules:
    """Thresholds of the cart recovery list; none is given, so all are ours."""

    urgent_value: float = 3000.0
    high_probability: float = 0.6
    medium_probability: float = 0.3


# Priority labels and what is offered for each.
CART_INCENTIVES = {
    "Urgent - High Value": "Personal call and free shipping",
    "High Priority": "Free shipping",
    "Medium Priority": "Discount code",
    "Low Priority": "Reminder",
}


def cart_recovery_campaign(
    features: DataFrame,
    predictions: DataFrame,
    customers: DataFrame,
    campaign_date: dt.date | str,
    rules: CartRules = CartRules(),
) -> DataFrame:
    """Customers with items in the cart over the last active days and no
    purchase, with a priority and an incentive."""
    carts = (
        on_day(features, "prediction_date", campaign_date)
        .where((F.col("add_to_cart_count_3d") >= 1) & (F.col("purchase_count_3d") == 0))
        .select(
            F.col("user_id").alias("customer_id"),
            F.col("add_to_cart_count_3d").alias("items_in_cart"),
            (F.col("add_to_cart_count_3d") * F.col("avg_product_price_3d")).alias("estimated_cart_value"),
        )
    )
    scored = on_day(predictions, "prediction_date", campaign_date).select(
        F.col("user_id").alias("customer_id"), "purchase_probability",
        F.col("prediction_date").alias("campaign_date"),
    )
    likely = F.col("purchase_probability")
    high = likely >= rules.high_probability
    priority = (
        F.when(high & (F.col("estimated_cart_value") >= rules.urgent_value), "Urgent - High Value")
        .when(high, "High Priority")
        .when(likely >= rules.medium_probability, "Medium Priority")
        .otherwise("Low Priority")
    )
    rows = (
        carts.join(scored, "customer_id")
        .join(contactable(customers).select("customer_id", "email"), "customer_id")
        .withColumn("recovery_priority", priority)
    )
    return rows.withColumn("recommended_incentive", _lookup("recovery_priority", CART_INCENTIVES))


def _lookup(column: str, texts: dict[str, str]) -> Column:
    out = F
    for key, text in texts.items():
        out = out.when(as_col(column) == key, text)
    return out


@dataclass(frozen=True)
class DormantRules:
    """Declared limits (first two) and value tiers of our own."""

    min_days: int = 30
    min_probability: float = 0.6
    vip_value: float = 3_000_000.0
    high_value: float = 2_000_000.0
    medium_value: float = 1_000_000.0


# Campaign priority and offer of each value tier.
TIER_PRIORITY = {
    "VIP": "VIP Re-engagement",
    "High Value": "High Priority",
    "Medium Value": "Standard Priority",
    "Low Value": "Low Priority",
}
TIER_OFFER = {
    "VIP": "Exclusive gift",
    "High Value": "Loyalty bonus",
    "Medium Value": "Discount code",
    "Low Value": "Newsletter",
}


def dormant_campaign(
    customer_value: DataFrame,
    predictions: DataFrame,
    customers: DataFrame,
    campaign_date: dt.date | str,
    rules: DormantRules = DormantRules(),
) -> DataFrame:
    """Customers without a purchase for a month or more who are likely to
    return.  ``customer_value`` is ``sales_reports.customer_value``."""
    today = F.lit(campaign_date).cast("date")
    last = key_to_date("last_date_key")
    quiet = customer_value.select(
        F.col("customer_key").alias("customer_id"),
        last.alias("last_order_date"),
        F.date_diff(today, last).alias("days_since_last_purchase"),
        "total_orders",
        "lifetime_value",
        (F.col("lifetime_value") / F.col("total_orders")).alias("avg_order_value"),
    ).where(F.col("days_since_last_purchase") >= rules.min_days)
    likely = (
        on_day(predictions, "prediction_date", campaign_date)
        .where(F.col("purchase_probability") >= rules.min_probability)
        .select(F.col("user_id").alias("customer_id"), "purchase_probability")
    )
    tier = banded(
        F.col("lifetime_value"),
        [(rules.vip_value, "VIP"), (rules.high_value, "High Value"), (rules.medium_value, "Medium Value")],
        "Low Value",
    )
    months = F.months_between(today, F.col("last_order_date"))
    dormancy = (
        F.when(months >= 6, "Long Dormant (6+ months)")
        .when(months >= 3, "Medium Dormant (3-6 months)")
        .otherwise("Recently Dormant (1-3 months)")
    )
    return (
        quiet.join(likely, "customer_id")
        .join(contactable(customers).select("customer_id", "email"), "customer_id")
        .withColumns({"dormancy_segment": dormancy, "value_tier": tier, "campaign_date": today})
        .withColumns(
            {
                "campaign_priority": _lookup("value_tier", TIER_PRIORITY),
                "recommended_offer": _lookup("value_tier", TIER_OFFER),
            }
        )
    )


def segment_sizes(campaign: DataFrame) -> DataFrame:
    return campaign.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(flag(F.col("phone").isNotNull())).alias("with_phone"),
    )
