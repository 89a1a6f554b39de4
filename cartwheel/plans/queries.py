"""Every operator as a query over a folder of source tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from cartwheel.operators import (
    activity,
    behaviour_mart,
    behaviour_reports,
    campaign,
    daily_metrics,
    dimensions,
    facts,
    history,
    learning,
    oltp,
    predictions,
    quality,
    sales_reports,
    session_features,
)
from cartwheel.plans.jobs import behaviour_features
from cartwheel.session import prepare, shared_dir, size_shuffles, staged
from cartwheel.sinks import snapshots, tables
from cartwheel.sources import bronze, extract, shop_tables
from cartwheel.streaming import ingest

SALES_END = dt.date(2001, 8, 1)
CAMPAIGN_DAY = dt.date(2024, 1, 15)
TRAIN_CUT_OFF = dt.date(2024, 1, 25)
SNAPSHOT_1 = dt.datetime(2024, 1, 1)
SNAPSHOT_2 = dt.datetime(2024, 2, 1)


# Whole-number columns that can be NULL, by query.  Clients hold them as
# integers or as floats, so they are shown as text.
NULLABLE_NUMBERS = {
    "user_sessions": ("user_id",),
    "bronze_json_sessions": ("user_id",),
    "session_actions": ("product_id",),
    "stream_ingest_actions": ("product_id",),
    "sessions_daily": ("user_id",),
    "actions_daily": ("user_id",),
    "user_daily_metric": ("user_id",),
    "session_features": ("user_id",),
    "session_features_joined": ("user_id",),
    "time_to_first_action": ("time_to_first_action",),
    "fact_user_behavior": ("user_id", "product_id", "product_key"),
    "campaign_scores": ("days_since_last_purchase",),
}


def portable(df: DataFrame, as_text: tuple[str, ...] = ()) -> DataFrame:
    """Dates, times and the named columns as text, so any engine's rows
    compare equal."""
    shown = []
    for field in df.schema.fields:
        name = column = f"`{field.name}`"
        if isinstance(field.dataType, DateType) or field.name in as_text:
            column = f"CAST({name} AS string)"
        elif isinstance(field.dataType, TimestampType):
            column = f"date_format({name}, 'yyyy-MM-dd HH:mm:ss')"
        shown.append(f"{column} AS {name}")
    return df.selectExpr(*shown)


class Shop:
    """The layers over one folder, built lazily and only as plans."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = prepare(spark), folder

    def bronze(self, table: str) -> DataFrame:
        rows = getattr(shop_tables, table)(self.spark, self.folder)
        return size_shuffles(rows) if table == "order_items" else rows

    @cached_property
    def orders(self) -> DataFrame:
        return oltp.orders(self.bronze("orders"))

    @cached_property
    def orders_items(self) -> DataFrame:
        return oltp.orders_items(self.bronze("order_items"), self.orders)

    @cached_property
    def products(self) -> DataFrame:
        return oltp.products(self.bronze("products"))

    @cached_property
    def categories(self) -> DataFrame:
        return oltp.categories(self.bronze("category"))

    @cached_property
    def brands(self) -> DataFrame:
        return oltp.brands(self.bronze("brands"))

    @cached_property
    def customers(self) -> DataFrame:
        return oltp.customers(self.bronze("customers"))

    @cached_property
    def payment_method(self) -> DataFrame:
        return oltp.payment_method(self.bronze("payment_method"))

    @cached_property
    def dim_products(self) -> DataFrame:
        return dimensions.dim_products(self.products, self.categories, self.brands)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dimensions.dim_customers(self.customers)

    @cached_property
    def sales_dates(self) -> DataFrame:
        return dimensions.date_attributes(dimensions.date_spine_of(self.orders, "order_date"))

    @cached_property
    def fact_orders(self) -> DataFrame:
        return facts.fact_orders(self.orders)

    @cached_property
    def sales(self) -> DataFrame:
        return facts.sales_lines(oltp.items_with_order(self.bronze("order_items"), self.orders))

    @cached_property
    def totals(self) -> DataFrame:
        return sales_reports.order_totals(oltp.items(self.bronze("order_items")), self.orders)

    @cached_property
    def logs(self) -> DataFrame:
        return self.bronze("activity_logs")

    @cached_property
    def sessions(self) -> DataFrame:
        return activity.user_sessions(self.logs)

    @cached_property
    def actions(self) -> DataFrame:
        return activity.session_actions(self.logs)

    @cached_property
    def features(self) -> DataFrame:
        return behaviour_features(self.logs)

    @cached_property
    def session_features(self) -> DataFrame:
        return session_features.session_features_from_logs(self.logs)

    @cached_property
    def behavior(self) -> DataFrame:
        dates = dimensions.date_attributes(dimensions.date_spine_of(self.actions, "action_timestamp"))
        return behaviour_mart.fact_user_behavior(self.logs, self.dim_products, dates)

    @cached_property
    def behavior_rows(self) -> DataFrame:
        return behaviour_mart.behaviour_rows(self.logs)

    @cached_property
    def daily_metrics(self) -> DataFrame:
        return behaviour_mart.fact_daily_metrics(self.behavior_rows)

    @cached_property
    def predictions(self) -> DataFrame:
        """Every user and day of the log with a probability from a formula
        instead of a model, so results can be checked."""
        day = F.col("timestamp").cast("date")
        users = self.sessions.where(F.col("user_id").isNotNull())
        pairs = users.select("user_id", day.alias("prediction_date")).distinct()
        probability = ((F.col("user_id") * 37 + F.day("prediction_date") * 11) % 100) / F.lit(100.0)
        return pairs.select(
            "user_id",
            "prediction_date",
            (probability >= 0.5).cast("int").alias("will_purchase_tomorrow"),
            probability.alias("purchase_probability"),
            F.col("prediction_date").cast("timestamp").alias("prediction_timestamp"),
        )

    @cached_property
    def campaign(self) -> DataFrame:
        return campaign.high_value_campaign(
            self.predictions, self.customers, CAMPAIGN_DAY, dt.datetime(2024, 1, 16)
        )


Query = Callable[[Shop], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _plain(name: str, build: Query) -> None:
    QUERIES[name] = build


# Silver and star schema.
_plain("silver_orders", lambda s: s.orders)
_plain("silver_orders_items", lambda s: s.orders_items)
_plain("silver_products", lambda s: s.products)
_plain("silver_customers", lambda s: s.customers)
_plain("silver_brands", lambda s: s.brands)
_plain("silver_categories", lambda s: s.categories)
_plain("silver_payment_method", lambda s: s.payment_method)
_plain("dim_products", lambda s: s.dim_products)
_plain("dim_customers", lambda s: s.dim_customers)
_plain("dim_payment_method", lambda s: dimensions.dim_payment_method(s.payment_method))
_plain("fact_orders", lambda s: s.fact_orders)
_plain("fact_order_items", lambda s: s.sales.drop("order_id"))
_plain("fact_order_items_from_silver", lambda s: facts.fact_order_items(s.orders_items, s.orders))
_plain("fact_sale_product_daily", lambda s: facts.fact_sale_product_daily(s.sales))


@query
def dim_date(s: Shop) -> DataFrame:
    return dimensions.date_attributes(dimensions.date_spine_of(s.orders, "order_date"))


@query
def dim_date_extended(s: Shop) -> DataFrame:
    dates = dimensions.date_attributes(dimensions.date_spine_of(s.orders, "order_date"))
    # Days without any order stand in for a holiday table.
    days = dates.select(F.col("calendar_date").alias("holiday_date"))
    sold = s.orders.select(F.col("order_date").alias("holiday_date"))
    quiet = days.join(sold, "holiday_date", "left_anti")
    return dimensions.dim_date_extended(dates, quiet, fiscal_start_month=4).select(
        "date_key", "day", "day_of_week", "is_holiday", "fiscal_year", "fiscal_quarter"
    )


# Sales reports.
_plain("daily_sales", lambda s: sales_reports.daily_sales(s.totals, s.sales_dates))
_plain("tier_value", lambda s: sales_reports.tier_value(s.totals, s.dim_customers))
_plain("weekday_sales", lambda s: sales_reports.weekday_sales(s.totals, s.sales_dates))
_plain("revenue_by_day", lambda s: sales_reports.revenue_by_period(s.totals, "day"))
_plain("revenue_by_week", lambda s: sales_reports.revenue_by_period(s.totals, "week"))
_plain("revenue_by_month", lambda s: sales_reports.revenue_by_period(s.totals, "month"))
_plain(
    "period_growth",
    lambda s: sales_reports.period_growth(sales_reports.revenue_by_period(s.totals, "month")),
)
_plain(
    "growth_week_over_week",
    lambda s: sales_reports.period_growth(sales_reports.revenue_by_period(s.totals, "week"), unit="week"),
)
_plain(
    "growth_year_over_year",
    lambda s: sales_reports.period_growth(sales_reports.revenue_by_period(s.totals, "month"), periods=12),
)
_plain(
    "category_growth",
    lambda s: sales_reports.period_growth(
        sales_reports.revenue_by_category(s.sales, s.dim_products, "month"), "category"
    ),
)
_plain("order_profile", lambda s: sales_reports.order_profile(s.totals))
_plain("best_sellers", lambda s: sales_reports.best_sellers(s.sales, s.dim_products))
_plain(
    "best_sellers_by_quantity",
    lambda s: sales_reports.best_sellers(s.sales, s.dim_products, "total_quantity_sold", 10),
)
_plain("brand_share", lambda s: sales_reports.revenue_share(s.sales, s.dim_products, "brand_name"))
_plain("category_share", lambda s: sales_reports.revenue_share(s.sales, s.dim_products, "category"))
_plain("discount_impact", lambda s: sales_reports.discount_impact(s.sales))
_plain("clv", lambda s: sales_reports.customer_value(s.totals))
_plain("top_customers", lambda s: sales_reports.top_customers(s.totals))
_plain("repeat_rate", lambda s: sales_reports.repeat_rate(s.fact_orders, s.dim_customers))
_plain("retention", lambda s: sales_reports.retention(s.fact_orders))
_plain(
    "churn_by_tier", lambda s: sales_reports.churn_by_tier(s.fact_orders, s.dim_customers, SALES_END)
)

# Activity log and features.
_plain("user_sessions", lambda s: s.sessions)
_plain("session_actions", lambda s: s.actions)
_plain("sessions_daily", lambda s: daily_metrics.sessions_daily(s.sessions))
_plain("actions_daily", lambda s: daily_metrics.actions_daily(s.actions, s.sessions))
_plain(
    "user_daily_metric",
    lambda s: daily_metrics.user_daily_metric(
        daily_metrics.sessions_daily(s.sessions),
        daily_metrics.actions_daily(activity.session_actions(s.logs, carry_user=True)),
    ),
)
_plain("user_behavior_3d_features", lambda s: s.features)
_plain("session_features", lambda s: s.session_features)
_plain(
    "session_features_joined", lambda s: session_features.session_features(s.sessions, s.actions)
)
_plain("time_to_first_action", lambda s: session_features.time_to_first_action(s.logs))
_plain(
    "conversion_by_segment",
    lambda s: session_features.conversion_by(s.session_features, "user_segment"),
)
_plain(
    "conversion_by_stage",
    lambda s: session_features.conversion_by(s.session_features, "reached_cart", "reached_checkout"),
)
_plain(
    "conversion_by_device", lambda s: session_features.conversion_by(s.session_features, "is_mobile")
)
_plain("label_counts", lambda s: session_features.label_counts(s.session_features))


@query
def feature_profile(s: Shop) -> DataFrame:
    # A mean of doubles depends on their order in the last digits.
    profile = session_features.feature_profile(s.session_features)
    return profile.withColumns({name: F.round(name, 10) for name in ("avg_action_velocity", "avg_cart_conversion")})



@query
def session_interactions(s: Shop) -> DataFrame:
    return session_features.with_interactions(s.session_features).select(
        "session_id", "time_of_day_bucket", "cart_adds_on_mobile", "duration_squared"
    )


# Behaviour mart and reports.
_plain("fact_user_behavior", lambda s: s.behavior)
_plain("fact_daily_metrics", lambda s: s.daily_metrics)
_plain("funnel", lambda s: behaviour_reports.funnel(s.behavior_rows))
_plain("channel_performance", lambda s: behaviour_reports.channel_performance(s.daily_metrics))
_plain(
    "product_engagement",
    lambda s: behaviour_reports.product_engagement(s.behavior, s.dim_products, min_views=50),
)
_plain("product_kpis", lambda s: behaviour_reports.product_kpis(s.behavior))
_plain("viewed_not_bought", lambda s: behaviour_reports.viewed_not_bought(s.behavior, 60, 25.0))
_plain("conversion_kpis", lambda s: behaviour_reports.conversion_kpis(s.daily_metrics))
_plain("engagement_kpis", lambda s: behaviour_reports.engagement_kpis(s.sessions))
_plain("weekly_active_users", lambda s: behaviour_reports.active_users(s.sessions, "week"))
_plain("source_performance", lambda s: behaviour_reports.source_performance(s.daily_metrics))
_plain("campaign_performance", lambda s: behaviour_reports.campaign_performance(s.behavior_rows))
_plain("search_terms", lambda s: behaviour_reports.search_terms(s.logs))


@query
def marketing_cost(s: Shop) -> DataFrame:
    # The shop has no spend table: three cents per second of a channel's sessions.
    spend = s.sessions.select(
        F.col("utm_source").alias("channel"),
        F.col("timestamp").cast("date").alias("date"),
        (F.col("duration_seconds") * 3 / F.lit(100.0)).alias("amount"),
    )
    users = s.sessions.groupBy(F.col("utm_source").alias("channel")).agg(
        F.count_distinct("user_id").alias("new_customers")
    )
    return behaviour_reports.marketing_cost(s.daily_metrics, spend, users)


# Predictions and campaigns.
_plain("campaign", lambda s: s.campaign)
_plain("hot_leads", lambda s: campaign.hot_leads(s.campaign))
_plain("campaign_segments", lambda s: campaign.segment_sizes(s.campaign))
_plain(
    "cart_recovery_campaign",
    lambda s: campaign.cart_recovery_campaign(s.features, s.predictions, s.customers, CAMPAIGN_DAY),
)
_plain("latest_prediction", lambda s: predictions.latest_per_key(s.predictions, "user_id", "prediction_timestamp"))
_plain("recent_predictions", lambda s: predictions.recent(s.predictions, "prediction_date", CAMPAIGN_DAY))
_plain(
    "positive_predictions",
    lambda s: predictions.positive_predictions(s.predictions, CAMPAIGN_DAY, 0.5),
)


@query
def unpredicted_customers(s: Shop) -> DataFrame:
    following = CAMPAIGN_DAY + dt.timedelta(days=1)
    return predictions.unpredicted(s.features, s.predictions, CAMPAIGN_DAY, following).select(
        "user_id", "prediction_date", "sessions_3d"
    )


@query
def prediction_summary(s: Shop) -> DataFrame:
    # A mean of doubles depends on their order in the last digits.
    mean = F.round("avg_probability", 10).alias("avg_probability")
    return predictions.run_summary(s.predictions).select("total", "predicted_buyers", mean)


@query
def intervention_bands(s: Shop) -> DataFrame:
    band = predictions.intervention_band(F.col("purchase_probability")).alias("band")
    return s.predictions.groupBy(band).agg(F.count(F.lit(1)).alias("predictions"))


def _moved_to_sales_end(s: Shop) -> DataFrame:
    """Predictions dated at the end of the order history, so that orders and
    predictions share a day: one per user, the first of the log."""
    first = s.predictions.groupBy("user_id").agg(
        F.min(F.struct("prediction_date", "purchase_probability")).alias("p")
    )
    likely = F.col("p.purchase_probability")
    return first.select(
        "user_id",
        F.lit(SALES_END).alias("prediction_date"),
        (likely >= 0.5).cast("int").alias("will_purchase_tomorrow"),
        likely.alias("purchase_probability"),
        F.lit(SALES_END).cast("timestamp").alias("prediction_timestamp"),
    )


@query
def dormant_campaign(s: Shop) -> DataFrame:
    return campaign.dormant_campaign(
        sales_reports.customer_value(s.totals), _moved_to_sales_end(s), s.customers, SALES_END
    )


@query
def campaign_scores(s: Shop) -> DataFrame:
    listed = campaign.high_value_campaign(_moved_to_sales_end(s), s.customers, SALES_END, SNAPSHOT_1)
    active = s.features.groupBy("user_id").agg(F.max("sessions_3d").alias("sessions_3d"))
    active = active.withColumn("prediction_date", F.lit(SALES_END))
    return campaign.campaign_scores(listed, active, s.fact_orders).select(
        "customer_id", "campaign_priority_score", "engagement_score", "estimated_clv",
        "primary_contact_channel", "orders_count_30d", "total_spent_30d", "days_since_last_purchase",
    )


# Sinks and history, checked on the table they leave behind.


@query
def merge_orders(s: Shop) -> DataFrame:
    """Open and finished orders first; then a batch with changed finished
    orders (urgent ones moved a month) and new pending ones."""
    status = s.spark.read.parquet(f"{s.folder}/orders.parquet").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status")
    )
    rows = s.orders.drop("created_at", "updated_at").join(status, "order_id")
    base = rows.where("status <> 'P'").drop("status")
    day = F.when(F.col("payment_method_id") == 1, F.add_months("order_date", 1)).otherwise(F.col("order_date"))
    changed = rows.where("status = 'F'").withColumns(
        {
            "total_amount": F.col("total_amount") + 1,
            "order_date": day,
            "year": F.year(day),
            "month": F.month(day),
            "day": F.day(day),
        }
    )
    batch = changed.unionByName(rows.where("status = 'P'")).drop("status")
    path = shared_dir(s.spark, "orders")
    tables.merge_into(base, path, ["order_id"], ["year", "month"])
    tables.merge_into(batch, path, ["order_id"], ["year", "month"])
    return s.spark.read.schema(base.schema).parquet(path)


@query
def replace_partition(s: Shop) -> DataFrame:
    path = shared_dir(s.spark, "predictions")
    rows = s.predictions.drop("prediction_timestamp")
    tables.write_partitions(rows, path, ["prediction_date"])
    again = predictions.on_day(rows, "prediction_date", CAMPAIGN_DAY).withColumn(
        "purchase_probability", F.lit(1.0) - F.col("purchase_probability")
    )
    for _ in range(2):
        tables.replace_partition(again, path, "prediction_date", CAMPAIGN_DAY)
    return s.spark.read.schema(rows.schema).parquet(path)


def _customer_snapshots(s: Shop) -> tuple[DataFrame, DataFrame]:
    """Furniture customers arrive late, machinery ones vanish, building ones
    change tier, and missing addresses are filled in."""
    rows = s.customers.drop("created_at", "updated_at", "address")
    first = rows.where("tier <> 'FURNITURE'")
    second = rows.where("tier <> 'MACHINERY'").withColumns(
        {
            "tier": F.when(F.col("tier") == "BUILDING", "GOLD").otherwise(F.col("tier")),
            "email": F.coalesce("email", F.lit("asked@example.com")),
        }
    )
    return first, second


@query
def scd2_customers(s: Shop) -> DataFrame:
    first, second = _customer_snapshots(s)
    path = shared_dir(s.spark, "history")
    tracked = history.TRACKED["customers"]
    snapshots.snapshot_table(first, path, "customer_id", tracked, SNAPSHOT_1)
    snapshots.snapshot_table(second, path, "customer_id", tracked, SNAPSHOT_2)
    return snapshots.read_history(s.spark, path)


@query
def scd2_dimension(s: Shop) -> DataFrame:
    first, second = _customer_snapshots(s)
    opened = history.first_snapshot(first, "customer_id", SNAPSHOT_1)
    state = history.scd2_check(opened, second, "customer_id", history.TRACKED["customers"], SNAPSHOT_2)
    return history.dimension_view(state, "customer_id").drop("surrogate_key")


@query
def bronze_csv_orders(s: Shop) -> DataFrame:
    """Orders written as headerless text by month, read back and cast."""
    path = shared_dir(s.spark, "csv")
    text = s.bronze("orders").withColumns(
        {name: F.date_format(name, "yyyy-MM-dd HH:mm:ss") for name in ("created_at", "updated_at")}
    )
    bronze.land_csv(text, "orders", path, ("year", "month"))
    return oltp.orders(bronze.read_bronze_csv(s.spark, "orders", path))


@query
def bronze_json_sessions(s: Shop) -> DataFrame:
    """Session records written as JSON lines by day, read back and flattened."""
    path = shared_dir(s.spark, "json")
    bronze.land_activity_logs(s.logs, path)
    return activity.user_sessions(bronze.read_activity_logs(s.spark, path))


@query
def extract_month_items(s: Shop) -> DataFrame:
    return extract.extract_month_items(s.bronze("order_items"), s.orders, 1998, 12)


@query
def stream_ingest_actions(s: Shop) -> DataFrame:
    """Session records as JSON lines, landed and merged by two streams."""
    landing, logs, target = (shared_dir(s.spark, name) for name in ("landing", "logs", "actions"))
    s.logs.drop("ingest_date").write.json(landing)
    ingest.ingest_logs(s.spark, landing, logs, shared_dir(s.spark, "offsets"))
    ingest.merge_actions(s.spark, logs, target, shared_dir(s.spark, "offsets"))
    return s.spark.read.schema(s.actions.schema).parquet(target)


# Checks.


def _check_tables(s: Shop) -> dict[str, DataFrame]:
    return {
        "orders": s.orders, "orders_items": s.orders_items, "customers": s.customers,
        "products": s.products, "categories": s.categories, "brands": s.brands,
        "payment_method": s.payment_method,
        "user_sessions": s.sessions, "session_actions": s.actions,
        "fact_sales": s.sales, "dim_products": s.dim_products, "dim_customers": s.dim_customers,
        "dim_date": s.sales_dates,
    }


_plain("dq_oltp", lambda s: quality.check_summary(quality.oltp_checks(), _check_tables(s)))
_plain("dq_activity", lambda s: quality.check_summary(quality.activity_checks(), _check_tables(s)))
_plain("dq_sales", lambda s: quality.check_summary(quality.sales_checks(SALES_END), _check_tables(s)))
_plain(
    "dq_duplicate_items",
    lambda s: quality.violations(quality.unique("orders_items", "order_item_id"), _check_tables(s)),
)
_plain("dq_equal_rowcount", lambda s: quality.equal_rowcount(s.sessions, s.actions))


# Models.  No SQL equivalent; results are compared by row count only.


@query
def train_and_score(s: Shop) -> DataFrame:
    features = staged(s.features, "features")
    model, _ = learning.train_next_day(features, TRAIN_CUT_OFF)
    return learning.score(model, features, F.lit(dt.datetime(2024, 1, 26)))


@query
def next_day_class_metrics(s: Shop) -> DataFrame:
    features = staged(s.features, "features")
    model, test = learning.train_next_day(features, TRAIN_CUT_OFF)
    return learning.class_metrics(model.transform(test))


def _session_parts(s: Shop) -> tuple[DataFrame, DataFrame]:
    rows = staged(learning.session_inputs(s.session_features), "inputs")
    return learning.split_by_key(rows, ["session_id"], 0.7)


@query
def model_comparison(s: Shop) -> DataFrame:
    _, metrics = learning.compare_classifiers(*_session_parts(s))
    return metrics


@query
def feature_importance(s: Shop) -> DataFrame:
    train, test = _session_parts(s)
    forest = {"random_forest": learning.session_classifiers()["random_forest"]}
    models, _ = learning.compare_classifiers(train, test, forest)
    return learning.feature_importance(models["random_forest"])


class LinearRule:
    """A tiny outside model for ``score_rows``: buys when carts beat views."""

    def predict_proba(self, matrix: np.ndarray) -> np.ndarray:
        share = matrix[:, 0] / (matrix[:, 0] + matrix[:, 1] + 1.0)
        return np.column_stack([1.0 - share, share])

    def predict(self, matrix: np.ndarray) -> np.ndarray:
        return (self.predict_proba(matrix)[:, 1] >= 0.25).astype(int)


@query
def score_outside_model(s: Shop) -> DataFrame:
    return learning.score_rows(
        s.features, LinearRule(), ["add_to_cart_count_3d", "view_count_3d"], ["user_id", "prediction_date"]
    )


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(name: str, build: Query) -> Callable[[SparkSession, str], DataFrame]:
        as_text = NULLABLE_NUMBERS.get(name, ())
        return lambda spark, folder: portable(build(Shop(spark, folder)), as_text)

    return {name: bind(name, build) for name, build in QUERIES.items()}
