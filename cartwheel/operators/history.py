"""Row history (slowly changing dimension, type 2) by column comparison."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID_FROM, VALID_TO, ROW_ID = "scd_valid_from", "scd_valid_to", "scd_row_id"

# Tracked columns of the three history tables.
TRACKED = {
    "customers": ("first_name", "last_name", "email", "phone_number", "gender", "tier"),
    "products": ("product_name", "product_description", "price", "category", "brand_name"),
    "payment_method": ("display_name", "provider", "type"),
}


def _row_id(key: str, since: Column) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), since.cast("string")))


def first_snapshot(current: DataFrame, key: str, as_of: dt.datetime | Column) -> DataFrame:
    """History of a table seen for the first time: every row is open."""
    since = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")
    return current.select(
        "*",
        _row_id(key, since).alias(ROW_ID),
        since.alias(VALID_FROM),
        F.lit(None).cast("timestamp").alias(VALID_TO),
    )


def scd2_check(
    history: DataFrame, current: DataFrame, key: str, check_columns: Sequence[str], as_of: dt.datetime | Column
) -> DataFrame:
    """Next state of the history.

    A row whose checked columns changed is closed at ``as_of`` and reopened
    with the new values; new keys are opened; keys gone from ``current`` stay
    open.  NULL and a value differ, NULL and NULL do not.

    Closed rows pass through untouched.  Only open rows, one per key, meet the
    current rows, in a single full join that emits 1 or 2 rows per key.
    """
    since = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")
    columns = [name for name in history.columns if name not in (ROW_ID, VALID_FROM, VALID_TO)]
    data = history.columns
    closed = history.where(F.col(VALID_TO).isNotNull())
    old = history.where(F.col(VALID_TO).isNull()).select(
        F.col(key).alias("old_key"), F.struct(*data).alias("old")
    )
    new = first_snapshot(current.select(*columns), key, since).select(
        F.col(key).alias("new_key"), F.struct(*data).alias("new")
    )
    same = F.lit(True)
    for name in check_columns:
        same = same & F.col("old")[name].eqNullSafe(F.col("new")[name])
    ended = F.col("old").withField(VALID_TO, since)
    outcome = (
        F.when(F.col("new_key").isNull(), F.array("old"))
        .when(F.col("old_key").isNull(), F.array("new"))
        .when(same, F.array("old"))
        .otherwise(F.array(ended, F.col("new")))
    )
    merged = old.join(new, F.col("old_key") == F.col("new_key"), "full").select(F.inline(outcome))
    return closed.select(*data).unionByName(merged.select(*data))


def dimension_view(history: DataFrame, key: str) -> DataFrame:
    """History as a dimension: surrogate key, effective dates, current flag."""
    rest = [name for name in history.columns if name not in (key, ROW_ID, VALID_FROM, VALID_TO)]
    return history.select(
        F.xxhash64(key, VALID_FROM).alias("surrogate_key"),
        F.col(key).alias("natural_key"),
        *rest,
        F.col(VALID_FROM).alias("effective_start_date"),
        F.col(VALID_TO).alias("effective_end_date"),
        F.col(VALID_TO).isNull().alias("is_current"),
    )
