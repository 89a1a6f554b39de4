import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import learning
from cartwheel.operators.quality import CheckFailure
from cartwheel.plans import jobs
from cartwheel.schemas import BRONZE_CSV
from tests.logs import action, frame, session


def bronze(spark, broken=False):
    def table(name, *lines):
        return spark.createDataFrame(list(lines), BRONZE_CSV[name])

    stamp = "2024-01-01 00:00:00"
    orders = table(
        "orders",
        ("1", "10", "2024-01-05", "30", "1", stamp, stamp),
        ("2", "20" if not broken else "77", "2024-01-06", "10", "1", stamp, stamp),
        ("3", "10", "2024-02-01", "10", "1", stamp, stamp),
    ).withColumns({"year": F.lit(2024), "month": F.substring("order_date", 6, 2).cast("int")})
    items = table(
        "order_items",
        ("11", "1", "5", "2", "10", "0.5"), ("12", "1", "6", "1", "10", "0"),
        ("21", "2", "5", "1", "10", "0"), ("31", "3", "5", "1", "10", "0"),
    ).withColumns({"year": F.lit(2024), "month": F.when(F.col("order_id") == "3", 2).otherwise(1)})
    return {
        "orders": orders,
        "order_items": items,
        "products": table("products", ("5", "tea", "", "10", "1", "b", stamp, stamp), ("6", "cup", "", "10", "1", "b", stamp, stamp)),
        "category": table("category", ("1", "food", "")),
        "brands": table("brands", ("b", "Acme", "VN")),
        "customers": table(
            "customers", *[(str(n), "f", "l", f"{n}@x", "1", "F", "Gold", "a", stamp, stamp) for n in (10, 20)]
        ),
        "payment_method": table("payment_method", ("1", "Card", "V", "card")),
    }


def test_monthly_mart(spark, folder, rows):
    lake = jobs.Lake(folder)
    for year, month in ((2024, 1), (2024, 2), (2024, 1)):
        jobs.monthly_sales_mart(spark, lake, bronze(spark), year, month)
    fact = spark.read.parquet(lake.path("sale_mart", "fact_order_items"))
    assert rows(fact, "order_item_id", "order_id", "total_amount", "month") == [
        (11, 1, 10.0, 1), (12, 1, 10.0, 1), (21, 2, 10.0, 1), (31, 3, 10.0, 2)
    ]
    assert spark.read.parquet(lake.path("silver", "orders")).count() == 3
    assert spark.read.parquet(lake.path("sale_mart", "fact_orders")).count() == 3
    assert spark.read.parquet(lake.path("sale_mart", "dim_date")).count() == 4018
    assert rows(spark.read.parquet(lake.path("sale_mart", "dim_products")), "product_id", "category") == [
        (5, "food"), (6, "food")
    ]


def test_broken_layer_stops_the_job(spark, folder):
    lake = jobs.Lake(folder)
    with pytest.raises(CheckFailure, match="orders.customer_id relationships: 1"):
        jobs.monthly_sales_mart(spark, lake, bronze(spark, broken=True), 2024, 1)


def test_daily_jobs(spark, folder, rows):
    lake = jobs.Lake(folder)
    days = [dt.date(2024, 1, n) for n in (1, 2, 3)]
    shop = [
        session(
            f"s{user}-{day}", user if user else None, f"{day}T23:59:50Z",
            [action("view", 0, product_id=5, price=2.0, page="/p")]
            + ([action("purchase", 20, product_id=5, price=2.0, total_amount=2.0)] if (user + day.day) % 2 else []),
        )
        for user in range(4)
        for day in days
    ]
    logs = frame(spark, *shop)
    for day in (*days, days[1]):
        jobs.daily_behaviour(spark, lake, logs, day)
    features = spark.read.parquet(lake.path("ml", "user_behavior_3d_agg_feature"))
    at_once = jobs.behaviour_features(logs)
    assert rows(features, *sorted(features.columns)) == rows(at_once, *sorted(at_once.columns))

    # A late session, and a known one that comes again with another start and user.
    fixed = session("s1-2024-01-02", 2, "2024-01-03T08:00:00Z", [action("view", 0, product_id=5)], day=days[2])
    late = session("late", 3, "2024-01-01T08:00:00Z", [action("view", 0)], day=days[2])
    kept = [s for s in shop if s[4] != "s1-2024-01-02"]
    second = frame(spark, *[s for s in kept if s[-1] == days[2]], fixed, late)
    jobs.daily_behaviour(spark, lake, second, days[2])
    at_once = jobs.behaviour_features(frame(spark, *kept, fixed, late))
    features = spark.read.parquet(lake.path("ml", "user_behavior_3d_agg_feature"))
    assert rows(features, *sorted(features.columns)) == rows(at_once, *sorted(at_once.columns))

    model = learning.fit(
        learning.next_day_pipeline(),
        learning.prepared(features, learning.DAILY_FEATURES, "label_purchase_tomorrow"),
    )
    customers = spark.createDataFrame(
        [(n, "f", "l", f"{n}@x", "1") for n in range(4)],
        "customer_id bigint, first_name string, last_name string, email string, phone_number string",
    )
    for day in (days[1], days[2], days[2]):
        jobs.daily_prediction(spark, lake, model, customers, day)
    predictions = spark.read.parquet(lake.path("ml", "next_day_purchase_prediction"))
    expected = features.where(F.col("prediction_date").isin(days[1:])).count()
    assert predictions.count() == expected
    campaign = spark.read.parquet(lake.path("marketing", "high_value_purchase_campaign"))
    buyers = predictions.where("will_purchase_tomorrow = 1 and purchase_probability >= 0.5").count()
    assert campaign.count() == buyers
