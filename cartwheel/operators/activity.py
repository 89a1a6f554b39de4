"""Silver tables of the activity log: flat sessions and exploded actions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scalars import as_int, as_stamp, flag, ymd

ACTION_TYPES = ("view", "add_to_cart", "purchase", "search", "wishlist", "review", "remove_from_cart")


def day_slice(etl_date: dt.date | str | None) -> Column:
    """Filter on the ingest partition; no date keeps every day."""
    if etl_date is None:
        return F.lit(True)
    return F.col("ingest_date") == F.lit(etl_date).cast("date")


def session_columns() -> list[Column | str]:
    """The flat columns of a nested session record.

    Revenue passes through single precision, as stored tables expect.
    """
    metrics = "session_metrics."
    return [
        "session_id",
        "user_id",
        as_stamp("timestamp").alias("timestamp"),
        F.col("device.type").alias("device_type"),
        F.col("device.os").alias("device_os"),
        F.col("device.browser").alias("browser"),
        "location.city",
        "location.country",
        F.col("location.coordinates.lat").alias("latitude"),
        F.col("location.coordinates.lon").alias("longitude"),
        as_int(metrics + "duration_seconds").alias("duration_seconds"),
        as_int(metrics + "page_views").alias("page_views"),
        as_int(metrics + "actions_count").alias("actions_count"),
        F.col(metrics + "has_purchase").try_cast("boolean").alias("has_purchase"),
        F.col(metrics + "revenue").try_cast("float").alias("revenue"),
        "user_segment",
        "referrer",
        "referrer_type",
        F.coalesce("source", F.lit("direct")).alias("utm_source"),
        F.col("campaign").alias("utm_campaign"),
        F.col("properties.is_mobile").try_cast("boolean").alias("is_mobile"),
        "properties.language",
        "properties.ab_test",
        *ymd("ingest_date"),
    ]


def user_sessions(logs: DataFrame, etl_date: dt.date | str | None = None) -> DataFrame:
    """One flat row per session record."""
    return logs.where(day_slice(etl_date)).select(*session_columns())


def exploded(logs: DataFrame, fields: Iterable[str], *carry: str) -> DataFrame:
    """One row per action with its 0-based position; sessions without actions
    vanish.

    ``fields`` names the action fields, ``carry`` the session columns to keep.
    Zipping the wanted fields instead of exploding whole actions lets the scan
    read only those fields of a columnar log.
    """
    wanted = F.arrays_zip(*[F.col(f"actions.{name}").alias(name) for name in fields])
    return logs.select(*carry, F.posexplode(wanted).alias("action_index", "action"))


def row_key(record_id: str) -> Column:
    """Deterministic key of an action, so a replay produces the same rows."""
    return F.md5(F.concat(F.col(record_id), F.col("action_index").cast("string")))


def action_time() -> Column:
    """Session start plus the action's offset in seconds."""
    return as_stamp("timestamp") + F.make_dt_interval(secs=as_int("action.time_offset").cast("decimal(18,6)"))


def type_flags(*kinds: str) -> list[Column]:
    return [flag(F.col("action.type") == kind).alias(f"is_{kind}") for kind in kinds]


# Output column -> action field it is taken from.
ACTION_COLUMNS = {
    "action_type": "type",
    "product_id": "product_id",
    "search_term": "search_term",
    "order_id": "order_id",
    "revenue": "total_amount",
    "product_price": "price",
    "product_category": "category",
}


def session_actions(
    logs: DataFrame,
    etl_date: dt.date | str | None = None,
    carry_user: bool = False,
    keep: Iterable[str] = tuple(ACTION_COLUMNS),
) -> DataFrame:
    """One row per action.

    ``carry_user`` adds the session's ``user_id``.  The daily metrics then
    need no join back to the sessions, which saves shuffling every action.
    ``keep`` limits the action columns, and with them the fields read.
    """
    carry = ["session_id", "timestamp", "ingest_date"] + (["user_id"] if carry_user else [])
    sources = {name: ACTION_COLUMNS[name] for name in keep}
    fields = dict.fromkeys(["type", "page", "time_offset", *sources.values()])
    rows = exploded(logs.where(day_slice(etl_date)), fields, *carry)
    on_checkout = (F.col("action.type") == "view") & (F.col("action.page") == "/checkout")
    return rows.select(
        row_key("session_id").alias("action_id"),
        "session_id",
        *(["user_id"] if carry_user else []),
        action_time().alias("action_timestamp"),
        *[F.col(f"action.{field}").alias(name) for name, field in sources.items()],
        *type_flags(*ACTION_TYPES),
        flag(on_checkout).alias("is_checkout_view"),
        *ymd("ingest_date"),
    )
