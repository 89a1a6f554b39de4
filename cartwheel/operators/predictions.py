"""Reading and summarising stored next-day purchase predictions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scalars import flag


def on_day(df: DataFrame, column: str, day: dt.date | str) -> DataFrame:
    return df.where(F.col(column) == F.lit(day).cast("date"))


def before_day(df: DataFrame, column: str, cut_off: dt.date | str) -> DataFrame:
    """Training cut-off: rows strictly before the date."""
    return df.where(F.col(column) < F.lit(cut_off).cast("date"))


def recent(df: DataFrame, column: str, as_of: dt.date | str, days: int = 7) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of`` and of that day."""
    day = F.lit(as_of).cast("date")
    return df.where(F.col(column).between(F.date_sub(day, days), day))


def latest_per_key(df: DataFrame, key: str, order_by: str) -> DataFrame:
    """The newest row of each key; equal times are decided by the other
    columns.  A maximum combines on the map side, so a hot key never gathers
    its rows in one task."""
    rest = [name for name in df.columns if name not in (key, order_by)]
    newest = F.max(F.struct(order_by, *rest)).alias("newest")
    return df.groupBy(key).agg(newest).select(key, "newest.*")


def positive_predictions(predictions: DataFrame, day: dt.date | str, floor: float | None = None) -> DataFrame:
    """Predicted buyers of a day, optionally from a probability upwards."""
    rows = on_day(predictions, "prediction_date", day).where(F.col("will_purchase_tomorrow") == 1)
    if floor is not None:
        rows = rows.where(F.col("purchase_probability") >= floor)
    return rows.select(
        F.col("user_id").alias("customer_id"),
        "prediction_date",
        "purchase_probability",
        F.col("prediction_timestamp").alias("predicted_at"),
    )


def unpredicted(features: DataFrame, predictions: DataFrame, feature_day: dt.date, target_day: dt.date) -> DataFrame:
    """Feature rows of a day whose user has no prediction for the target day."""
    done = on_day(predictions, "prediction_date", target_day).select("user_id")
    return on_day(features, "prediction_date", feature_day).join(done, "user_id", "left_anti")


def run_summary(predictions: DataFrame, class_column: str = "will_purchase_tomorrow") -> DataFrame:
    """One row: predictions, predicted buyers, mean probability."""
    return predictions.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(flag(F.col(class_column) == 1)).alias("predicted_buyers"),
        F.avg("purchase_probability").alias("avg_probability"),
    )


def intervention_band(probability: Column) -> Column:
    """What to do with a visitor at a given purchase probability."""
    return (
        F.when(probability > 0.70, "minimal intervention")
        .when(probability >= 0.30, "targeted offer")
        .otherwise("remarketing")
    )
