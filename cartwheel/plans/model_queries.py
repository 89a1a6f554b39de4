"""Queries on slices, and on models whose scores are a formula, so that every
row of their evaluation can be checked."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.operators import activity, evaluation, learning, oltp, predictions, sales_reports, session_features
from cartwheel.plans.queries import CAMPAIGN_DAY, NULLABLE_NUMBERS, SALES_END, TRAIN_CUT_OFF, LinearRule, Shop, query
from cartwheel.plans.slices import RunLog, partition_slices
from cartwheel.session import shared_dir, staged
from cartwheel.sources import bronze

NULLABLE_NUMBERS |= {"session_actions_day": ("product_id",)}
KEYS = ("user_id", "prediction_date")


@query
def silver_orders_month(s: Shop) -> DataFrame:
    """The month that follows the last one in the run log."""
    path, log = shared_dir(s.spark, "csv"), RunLog(s.spark, shared_dir(s.spark, "runs"))
    text = s.bronze("orders").withColumns(
        {name: F.date_format(name, "yyyy-MM-dd HH:mm:ss") for name in ("created_at", "updated_at")}
    )
    bronze.land_csv(text, "orders", path, ("year", "month"))
    log.record("silver_orders", "1998-11")
    year, month = map(int, log.next("silver_orders", partition_slices(s.spark, path, ("year", "month"))).split("-"))
    return oltp.orders(bronze.read_bronze_csv(s.spark, "orders", path), year, month)


@query
def session_actions_day(s: Shop) -> DataFrame:
    """The ingest day that follows the last one in the run log."""
    path, log = shared_dir(s.spark, "json"), RunLog(s.spark, shared_dir(s.spark, "runs"))
    bronze.land_activity_logs(s.logs, path)
    log.record("session_actions", str(CAMPAIGN_DAY - dt.timedelta(days=1)))
    day = log.next("session_actions", partition_slices(s.spark, path, ("ingest_date",)))
    return activity.session_actions(bronze.read_activity_logs(s.spark, path), day)


@query
def daily_sales_30d(s: Shop) -> DataFrame:
    return sales_reports.daily_sales(s.totals, s.sales_dates, SALES_END - dt.timedelta(days=30), SALES_END)


@query
def winsorised_sessions(s: Shop) -> DataFrame:
    """Two session measures clamped to their 5 % and 95 % quantiles."""
    rows = session_features.winsorised(s.session_features, "duration_seconds", 0.05, 0.95)
    rows = session_features.winsorised(rows, "avg_product_price", 0.05, 0.95)
    return rows.select("session_id", "duration_seconds", "avg_product_price")


def cart_share() -> Column:
    carts, views = F.col("add_to_cart_count_3d"), F.col("view_count_3d")
    return carts.cast("double") / (carts + views + 1).cast("double")


def _scored(s: Shop) -> DataFrame:
    """Three models: a habit of user and day, the share of carts, a constant."""
    habit = ((F.col("user_id") * 37 + F.day("prediction_date") * 11) % 100) / F.lit(100.0)
    models = {"habit": habit, "carts": cart_share(), "constant": F.lit(0.5)}
    lines = F.array(*[F.struct(F.lit(name).alias("model"), score.alias("score")) for name, score in models.items()])
    return s.features.select(F.col("label_purchase_tomorrow").alias("label"), F.inline(lines))


@query
def auc_formula(s: Shop) -> DataFrame:
    return evaluation.auc(_scored(s))


@query
def threshold_sweep_formula(s: Shop) -> DataFrame:
    return evaluation.threshold_sweep(_scored(s))


@query
def best_threshold_formula(s: Shop) -> DataFrame:
    return evaluation.best_threshold(_scored(s))


@query
def confusion_counts(s: Shop) -> DataFrame:
    return evaluation.confusion_counts(_scored(s), 0.4)


@query
def best_model(s: Shop) -> DataFrame:
    return learning.best_model(evaluation.model_metrics(_scored(s), 0.4))


@query
def class_metrics_formula(s: Shop) -> DataFrame:
    rows = _scored(s).where("model = 'carts'").withColumn("prediction", F.when(F.col("score") >= 0.4, 1.0).otherwise(0.0))
    return learning.class_metrics(rows)


@query
def permutation_importance(s: Shop) -> DataFrame:
    """Of the cart model; it does not read the sessions."""
    inputs = ("add_to_cart_count_3d", "view_count_3d", "sessions_3d")
    return evaluation.permutation_importance(s.features, KEYS, inputs, cart_share, "label_purchase_tomorrow")


def _inputs(s: Shop) -> DataFrame:
    rows = predictions.before_day(s.features, "prediction_date", TRAIN_CUT_OFF)
    return learning.prepared(rows, learning.DAILY_FEATURES, "label_purchase_tomorrow", KEYS)


@query
def model_inputs(s: Shop) -> DataFrame:
    return _inputs(s)


@query
def scaled_inputs(s: Shop) -> DataFrame:
    """Inputs as the scaler of the next-day model sees them, six decimals."""
    rows = staged(_inputs(s), "inputs")
    scaled = Pipeline(stages=learning.next_day_pipeline().getStages()[:2]).fit(rows).transform(rows)
    values = vector_to_array("features")
    return scaled.select(*KEYS, *[F.round(values[i], 6).alias(name) for i, name in enumerate(learning.DAILY_FEATURES)])


@query
def class_weights(s: Shop) -> DataFrame:
    weighted = learning.with_class_weights(_inputs(s))
    return weighted.groupBy("label", "class_weight").agg(F.count(F.lit(1)).alias("rows"))


@query
def score_outside_model_day(s: Shop) -> DataFrame:
    day = predictions.on_day(s.features, "prediction_date", CAMPAIGN_DAY)
    return learning.score_rows(day, LinearRule(), ["add_to_cart_count_3d", "view_count_3d"], list(KEYS))
