"""The shop's recurring jobs, each one composition of operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators import activity, campaign, daily_metrics, dimensions, facts, learning, oltp, quality
from cartwheel.session import prepare, staged
from cartwheel.sinks import files, tables

DAY_PARTITIONS = ("year", "month", "day")


@dataclass(frozen=True)
class Lake:
    """Where the layers live: ``root/schema/table``."""

    root: str

    def path(self, schema: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{schema}/{table}"


def silver_dimensions(bronze: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "products": oltp.products(bronze["products"]),
        "categories": oltp.categories(bronze["category"]),
        "brands": oltp.brands(bronze["brands"]),
        "customers": oltp.customers(bronze["customers"]),
        "payment_method": oltp.payment_method(bronze["payment_method"]),
    }


def monthly_sales_mart(
    spark: SparkSession, lake: Lake, bronze: Mapping[str, DataFrame], year: int, month: int,
    spine: tuple[dt.date, dt.date] = (dimensions.SPINE_START, dimensions.SPINE_END),
) -> None:
    """One month of orders and items into silver and gold, dimensions in full.

    Items meet their orders once; silver items and the sales fact are both
    read from that joined, stored slice.
    """
    prepare(spark)
    silver = silver_dimensions(bronze)
    keep = (F.col("year") == year) & (F.col("month") == month)
    orders = staged(oltp.orders(bronze["orders"], year, month), "orders")
    joined = staged(
        oltp.items_with_order(bronze["order_items"].where(keep).drop("year", "month"), orders), "items"
    )
    items = joined.drop("customer_id", "order_date", "payment_method_id")
    quality.run_checks(quality.oltp_checks(), {**silver, "orders": orders, "orders_items": items})

    def upsert(rows: DataFrame, schema: str, table: str, key: str) -> None:
        tables.merge_into(rows, lake.path(schema, table), [key], DAY_PARTITIONS)

    upsert(orders, "silver", "orders", "order_id")
    upsert(items, "silver", "orders_items", "order_item_id")
    for name, df in silver.items():
        df.write.mode("overwrite").parquet(lake.path("silver", name))
    gold = {
        "dim_customers": dimensions.dim_customers(silver["customers"]),
        "dim_products": dimensions.dim_products(silver["products"], silver["categories"], silver["brands"]),
        "dim_payment_method": dimensions.dim_payment_method(silver["payment_method"]),
        "dim_date": dimensions.dim_date(spark, *spine),
    }
    for name, df in gold.items():
        df.write.mode("overwrite").parquet(lake.path("sale_mart", name))
    upsert(facts.fact_orders(orders), "sale_mart", "fact_orders", "order_id")
    upsert(facts.sales_lines(joined), "sale_mart", "fact_order_items", "order_item_id")


def behaviour_features(logs: DataFrame, include_anonymous: bool = False) -> DataFrame:
    """Session records to three-day features in one plan.

    Anonymous sessions leave first, and actions take their user from the
    record, so the actions are never joined back to the sessions.
    """
    known = logs if include_anonymous else logs.where(F.col("user_id").isNotNull())
    sessions = daily_metrics.sessions_daily(activity.user_sessions(known))
    actions = daily_metrics.actions_daily(
        activity.session_actions(known, carry_user=True, keep=daily_metrics.DAILY_ACTION_COLUMNS)
    )
    daily = daily_metrics.user_daily_metric(sessions, actions)
    return daily_metrics.user_behavior_features(daily, include_anonymous=include_anonymous)


def _touched_days(batch: DataFrame, path: str, key: str, column: str) -> DataFrame:
    """Days of a batch's rows and of the stored rows they replace; only the
    partitions that hold such rows are read.

    A handful of dates, whatever the number of rows.
    """
    day = F.col(column).cast("date").alias("day")
    days = batch.select(day)
    before = tables.stored_rows(batch, path, [key], DAY_PARTITIONS, [column])
    if before is not None:
        days = days.unionByName(before.select(day))
    return days.where("day IS NOT NULL").distinct()


def _on_days(rows: DataFrame, column: str, days: list[dt.date]) -> DataFrame:
    """Rows of the given days.  The range on the bare column lets the file
    statistics skip everything outside it."""
    stamp = F.col(column)
    after = F.lit(days[-1] + dt.timedelta(days=1)).cast("timestamp")
    in_range = (stamp >= F.lit(days[0]).cast("timestamp")) & (stamp < after)
    return rows.where(in_range & stamp.cast("date").isin(*days))


def daily_behaviour(spark: SparkSession, lake: Lake, logs: DataFrame, etl_date: dt.date) -> None:
    """One ingest day into the silver log tables, its user-days, the features.

    Only the user-days of the dates the batch touches are computed again,
    including dates that lose a corrected session.  The window of the features
    then runs over stored user-days, not over sessions and actions.  Stored
    actions carry the user they arrived with, so they need no join to the
    sessions.

    The touched dates are written down before the silver tables change and
    struck off once the user-days and features are in place, so a run that
    dies in between leaves them to the next one.
    """
    prepare(spark)
    batches = {
        "user_sessions": ("session_id", "timestamp", staged(activity.user_sessions(logs, etl_date), "sessions")),
        "session_actions": (
            "action_id", "action_timestamp",
            staged(activity.session_actions(logs, etl_date, carry_user=True), "actions"),
        ),
    }
    quality.run_checks(quality.activity_checks(), {name: batch for name, (_, _, batch) in batches.items()})
    user_days = lake.path("ml", "user_daily_metric")
    to_do = f"{user_days}.touched"
    for name, (key, stamp, batch) in batches.items():
        days = _touched_days(batch, lake.path("silver", name), key, stamp)
        days.coalesce(1).write.mode("append").parquet(to_do)
    touched = {r.day for r in spark.read.parquet(to_do).distinct().collect()}
    stored: dict[str, DataFrame] = {}
    for name, (key, _, batch) in batches.items():
        path = lake.path("silver", name)
        tables.merge_into(batch, path, [key], DAY_PARTITIONS)
        stored[name] = spark.read.schema(batch.schema).parquet(path).where(F.col("user_id").isNotNull())
    if touched:
        days = sorted(touched)
        daily = daily_metrics.user_daily_metric(
            daily_metrics.sessions_daily(_on_days(stored["user_sessions"], "timestamp", days)),
            daily_metrics.actions_daily(_on_days(stored["session_actions"], "action_timestamp", days)),
        )
        tables.replace_partitions(daily, user_days, "activity_date", days)
    features = daily_metrics.user_behavior_features(spark.read.parquet(user_days))
    features.write.mode("overwrite").parquet(lake.path("ml", "user_behavior_3d_agg_feature"))
    files.delete(spark, to_do)


def daily_prediction(
    spark: SparkSession, lake: Lake, model: PipelineModel, customers: DataFrame, day: dt.date
) -> None:
    """Scores one day, replaces that day's predictions, updates the campaign."""
    prepare(spark)
    features = spark.read.parquet(lake.path("ml", "user_behavior_3d_agg_feature"))
    predictions = lake.path("ml", "next_day_purchase_prediction")
    tables.replace_partition(learning.score_day(model, features, day), predictions, "prediction_date", day)
    targets = staged(
        campaign.high_value_campaign(spark.read.parquet(predictions), customers, day), "campaign"
    )
    quality.run_checks(quality.campaign_checks(), {"high_value_purchase_campaign": targets})
    tables.merge_into(
        targets, lake.path("marketing", "high_value_purchase_campaign"),
        ["customer_id", "campaign_date"], DAY_PARTITIONS,
    )
