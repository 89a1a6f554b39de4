import datetime as dt

import pytest

from cartwheel.operators import campaign, predictions as p

DAY = dt.date(2024, 1, 15)
STAMP = dt.datetime(2024, 1, 15, 6)
SCHEMA = (
    "user_id bigint, prediction_date date, will_purchase_tomorrow int, purchase_probability double,"
    " prediction_timestamp timestamp"
)


@pytest.fixture
def scored(spark):
    lines = [
        (1, DAY, 1, 0.80, STAMP), (2, DAY, 1, 0.60, STAMP), (3, DAY, 1, 0.50, STAMP), (4, DAY, 1, 0.49, STAMP),
        (5, DAY, 1, 0.90, STAMP), (6, DAY, 0, 0.95, STAMP), (None, DAY, 1, 0.9, STAMP),
        (1, DAY - dt.timedelta(days=1), 1, 0.99, STAMP - dt.timedelta(days=1)),
    ]
    return spark.createDataFrame(lines, SCHEMA)


@pytest.fixture
def customers(spark):
    lines = [(n, "f", "l", None if n == 5 else f"{n}@x", "1") for n in range(1, 7)]
    return spark.createDataFrame(
        lines, "customer_id bigint, first_name string, last_name string, email string, phone_number string"
    )


def test_segments(scored, customers, rows):
    out = campaign.high_value_campaign(scored, customers, DAY, STAMP)
    assert rows(out, "customer_id", "customer_segment", "campaign_action", "day") == [
        (1, "Hot Lead", "Send Premium Offer", 15),
        (2, "Warm Lead", "Send Discount Code", 15),
        (3, "Cold Lead", "Send General Newsletter", 15),
    ]


def test_hot_leads_and_sizes(scored, customers, rows):
    out = campaign.high_value_campaign(scored, customers, DAY, STAMP)
    assert rows(campaign.hot_leads(out), "customer_id") == [(1,)]
    assert rows(campaign.segment_sizes(out)) == [("Cold Lead", 1, 1), ("Hot Lead", 1, 1), ("Warm Lead", 1, 1)]


def test_latest_and_recent(scored, rows):
    latest = p.latest_per_key(scored, "user_id", "prediction_timestamp")
    assert rows(latest.where("user_id = 1"), "purchase_probability") == [(0.80,)]
    assert p.recent(scored, "prediction_date", DAY, 0).count() == 7
    assert p.recent(scored, "prediction_date", DAY, 1).count() == 8
    assert p.recent(scored, "prediction_date", DAY - dt.timedelta(days=1), 0).count() == 1


def test_unpredicted(spark, scored, rows):
    features = spark.createDataFrame([(1, DAY), (8, DAY), (9, DAY - dt.timedelta(days=1))], "user_id bigint, prediction_date date")
    assert rows(p.unpredicted(features, scored, DAY, DAY), "user_id") == [(8,)]


def test_summary_and_bands(spark, scored, rows):
    assert rows(p.run_summary(scored), "total", "predicted_buyers") == [(8, 7)]
    odds = spark.createDataFrame([(0.71,), (0.70,), (0.30,), (0.29,)], "x double")
    assert [r[1] for r in sorted(odds.select("x", p.intervention_band(odds.x)).collect(), reverse=True)] == [
        "minimal intervention", "targeted offer", "targeted offer", "remarketing"
    ]


def test_cart_recovery(spark, scored, customers, rows):
    features = spark.createDataFrame(
        [(1, DAY, 4, 0, 1000.0), (2, DAY, 1, 0, 10.0), (4, DAY, 1, 0, 10.0), (3, DAY, 2, 1, 10.0), (6, DAY, 0, 0, 0.0)],
        "user_id bigint, prediction_date date, add_to_cart_count_3d bigint, purchase_count_3d bigint, avg_product_price_3d double",
    )
    out = campaign.cart_recovery_campaign(features, scored, customers, DAY)
    assert rows(out, "customer_id", "items_in_cart", "estimated_cart_value", "recovery_priority") == [
        (1, 4, 4000.0, "Urgent - High Value"), (2, 1, 10.0, "High Priority"), (4, 1, 10.0, "Medium Priority")
    ]


def test_dormant(spark, scored, customers, rows):
    value = spark.createDataFrame(
        [(1, 4e6, 2, 20230101), (2, 1e6, 4, 20231215), (3, 5.0, 1, 20231001), (6, 2e6, 1, 20231010)],
        "customer_key bigint, lifetime_value double, total_orders bigint, last_date_key int",
    )
    out = campaign.dormant_campaign(value, scored, customers, DAY)
    assert rows(out, "customer_id", "days_since_last_purchase", "dormancy_segment", "value_tier", "campaign_priority") == [
        (1, 379, "Long Dormant (6+ months)", "VIP", "VIP Re-engagement"),
        (2, 31, "Recently Dormant (1-3 months)", "Medium Value", "Standard Priority"),
        (6, 97, "Medium Dormant (3-6 months)", "High Value", "High Priority"),
    ]


def test_scores(spark, scored, customers, rows):
    listed = campaign.high_value_campaign(scored, customers, DAY, STAMP)
    features = spark.createDataFrame([(1, DAY, 20)], "user_id bigint, prediction_date date, sessions_3d bigint")
    orders = spark.createDataFrame(
        [(1, 1, 20240115, 10.0), (2, 1, 20231201, 5.0), (3, 1, 20240116, 99.0)],
        "order_id bigint, customer_key bigint, date_key int, total_amount double",
    )
    out = campaign.campaign_scores(listed, features, orders)
    assert rows(out.where("customer_id < 3"), "customer_id", "campaign_priority_score", "orders_count_30d",
                "total_spent_30d", "estimated_clv", "primary_contact_channel") == [
        (1, 48.0 + 25.0 + 15.0, 1, 10.0, 15.0 + 8.0, "Email"), (2, 36.0, 0, 0.0, 0.0, "Email")
    ]
