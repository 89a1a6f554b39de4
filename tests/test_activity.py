import datetime as dt
import hashlib

import pytest

from cartwheel.operators import activity, session_features
from tests.logs import action, frame, session


@pytest.fixture
def logs(spark):
    return frame(
        spark,
        session("s1", 1, "2024-01-01T23:59:30Z", [
            action("view", 0, product_id=5, price=2.0, category="c1", page="/p"),
            action("view", 20, page="/checkout"),
            action("add_to_cart", 25, product_id=5, price=2.0),
            action("purchase", 60, product_id=5, price=4.0, order_id="o1", total_amount=10.1),
            action(None, 61),
        ], source="email"),
        session("s2", 2, actions=[]),
        session("s3", 2, actions=None),
        session("s4", None, "2024-01-02T10:00:00Z", [action("search", 5, search_term="tea", results_count=0)]),
    )


def test_every_session_is_kept_flat(logs, rows):
    out = activity.user_sessions(logs)
    assert rows(out, "session_id", "utm_source", "latitude", "has_purchase") == [
        ("s1", "email", 21.0, True), ("s2", "direct", 21.0, False),
        ("s3", "direct", 21.0, False), ("s4", "direct", 21.0, False),
    ]
    assert dict(out.dtypes)["revenue"] == "float"


def test_sessions_without_actions_vanish_when_exploded(logs, rows):
    assert {r[0] for r in rows(activity.session_actions(logs), "session_id")} == {"s1", "s4"}


def test_flags(logs, rows):
    flags = ["is_view", "is_checkout_view", "is_add_to_cart", "is_purchase", "is_search", "is_review"]
    out = activity.session_actions(logs).where("session_id = 's1'")
    by_type = {(r[0], r[1]): r[2:] for r in rows(out, "action_type", "product_id", *flags)}
    assert by_type[("view", 5)] == (1, 0, 0, 0, 0, 0)
    assert by_type[("view", None)] == (1, 1, 0, 0, 0, 0)
    assert by_type[("add_to_cart", 5)] == (0, 0, 1, 0, 0, 0)
    assert by_type[(None, None)] == (0, 0, 0, 0, 0, 0)


def test_key_and_time(logs, rows):
    out = activity.session_actions(logs).where("action_type = 'purchase'")
    assert rows(out, "action_id", "action_timestamp", "revenue", "day") == [
        (hashlib.md5(b"s13").hexdigest(), dt.datetime(2024, 1, 2, 0, 0, 30), 10.1, 1)
    ]


def test_day_slice(logs, rows):
    assert rows(activity.user_sessions(logs, "2024-01-02"), "session_id") == [("s4",)]
    assert rows(activity.session_actions(logs, dt.date(2024, 1, 2)), "session_id") == [("s4",)]


def test_nested_and_joined_session_features_agree(logs, rows):
    joined = session_features.session_features(activity.user_sessions(logs), activity.session_actions(logs))
    nested = session_features.session_features_from_logs(logs)
    columns = sorted(joined.columns)
    assert sorted(nested.columns) == columns
    assert rows(nested, *columns) == rows(joined, *columns)


def test_nested_session_features_need_no_shuffle(logs):
    plan = session_features.session_features_from_logs(logs)._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_session_feature_values(logs, rows):
    out = session_features.session_features_from_logs(logs)
    assert rows(out.where("session_id = 's1'"), "num_views", "has_checkout_view", "unique_products_viewed",
                "unique_categories_viewed", "avg_product_price", "price_range_interest", "cart_conversion_rate") == [
        (2, 1, 1, 1, 8 / 3, 2.0, 0.5)
    ]
    assert rows(out.where("session_id = 's3'"), "num_views", "avg_product_price", "cart_conversion_rate") == [(0, 0.0, 0.0)]


def test_zero_duration_gives_zero_rates(spark, rows):
    out = session_features.session_features_from_logs(
        frame(spark, session("z", 1, actions=[action("view")], duration=0, pages=0))
    )
    assert rows(out, "action_velocity", "avg_time_per_page") == [(0.0, 0.0)]


def test_time_to_first_action(logs, rows):
    out = session_features.time_to_first_action(logs)
    assert rows(out) == [("s1", 0), ("s2", None), ("s3", None), ("s4", 5)]


def test_hour_buckets(spark, rows):
    hours = spark.createDataFrame([(h,) for h in (0, 5, 6, 11, 12, 17, 18, 23)], "h int")
    out = hours.select("h", session_features.hour_bucket("h").alias("b"))
    assert [b for _, b in sorted(out.collect())] == [
        "night", "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening"
    ]


def test_winsorised_clamps_to_quantiles(spark, rows):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    values = [r[0] for r in session_features.winsorised(df, "x", 0.05, 0.95).collect()]
    assert (min(values), max(values), len(values)) == (5.0, 95.0, 100)


def test_conversion_by_stage(logs, rows):
    out = session_features.conversion_by(session_features.session_features_from_logs(logs), "reached_cart")
    assert rows(out, "reached_cart", "sessions", "conversion_rate") == [(0, 3, 0.0), (1, 1, 1.0)]


def read_schema(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("ReadSchema"):]


def test_only_wanted_action_fields_are_read(spark, logs, folder):
    from cartwheel.operators.behaviour_reports import search_terms
    from cartwheel.schemas import LANDED_LOG

    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    logs.write.partitionBy("ingest_date").parquet(f"{folder}/logs")
    stored = spark.read.schema(LANDED_LOG).parquet(f"{folder}/logs")
    assert "actions:array<struct<type:string,search_term:string,results_count:int>>" in read_schema(search_terms(stored))
    for df in (activity.session_actions(stored), session_features.session_features_from_logs(stored)):
        assert "items:" not in read_schema(df) and "product_name" not in read_schema(df)
    day = activity.session_actions(stored, "2024-01-02")
    assert "PartitionFilters: [isnotnull(ingest_date" in day._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
