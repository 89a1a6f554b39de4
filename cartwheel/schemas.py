"""Bronze layouts.

CSV extracts have no header, so column order matters.  Every CSV column is
read as text and cast in the silver layer, where a bad value becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Column order of the headerless extracts.
BRONZE_CSV = {
    "orders": _text(
        "order_id", "customer_id", "order_date", "total_amount",
        "payment_method_id", "created_at", "updated_at",
    ),
    "order_items": _text(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount",
    ),
    "products": _text(
        "product_id", "product_name", "product_description", "price",
        "category_id", "brand_id", "created_at", "updated_at",
    ),
    "category": _text("category_id", "category_display_name", "category_description"),
    "brands": _text("brand_id", "brand_name", "brand_origin"),
    "customers": _text(
        "customer_id", "first_name", "last_name", "email", "phone_number",
        "gender", "tier", "address", "created_at", "updated_at",
    ),
    "payment_method": _text("payment_method_id", "display_name", "provider", "type"),
}

def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_STR, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_DBL, _BOOL = T.DoubleType(), T.BooleanType()

# One JSON object per session, with its actions nested.
ACTION = _struct(
    type=_STR, page=_STR, time_offset=_INT, product_id=_LONG, product_name=_STR,
    category=_STR, price=_DBL, quantity=_INT, search_term=_STR, results_count=_INT,
    rating=_INT, order_id=_STR, total_amount=_DBL, payment_method=_STR,
    items=T.ArrayType(_struct(product_id=_LONG, product_name=_STR, quantity=_INT, price=_DBL)),
)
ACTIVITY_LOG = _struct(
    event_id=_STR, timestamp=_STR, user_id=_LONG, user_segment=_STR, session_id=_STR,
    device=_struct(type=_STR, os=_STR, browser=_STR, version=_STR),
    location=_struct(city=_STR, country=_STR, coordinates=_struct(lat=_DBL, lon=_DBL)),
    referrer=_STR, referrer_type=_STR, source=_STR, campaign=_STR,
    actions=T.ArrayType(ACTION),
    session_metrics=_struct(
        duration_seconds=_INT, page_views=_INT, actions_count=_INT, has_purchase=_BOOL, revenue=_DBL
    ),
    properties=_struct(ab_test=_STR, language=_STR, currency=_STR, is_mobile=_BOOL),
)
# The record as read back from its ``ingest_date=`` folders.
LANDED_LOG = T.StructType([*ACTIVITY_LOG.fields, T.StructField("ingest_date", T.DateType())])
