"""One key holds a third of all rows: plans must split it or never gather it."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import behaviour_mart, behaviour_reports, dimensions, facts, oltp, sales_reports

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
}


@pytest.fixture
def small_partitions(spark):
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL:
        spark.conf.unset(key)


@pytest.fixture
def bronze(spark):
    orders = spark.range(3000).select(
        F.col("id").alias("order_id"), (F.col("id") % 50).alias("customer_id"),
        F.expr("date_add(date'2024-01-01', int(id % 300))").alias("order_date"),
        F.lit(1.0).alias("total_amount"), F.lit(1).alias("payment_method_id"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )
    # A third of the lines belong to order 7.
    items = spark.range(0, 60000, 1, 6).select(
        F.col("id").alias("order_item_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 3000).alias("order_id"),
        (F.col("id") % 400).alias("product_id"), F.lit(1).alias("quantity"),
        (F.col("id") % 97).cast("double").alias("unit_price"), F.lit(0.1).alias("discount"),
    )
    return oltp.orders(orders), items


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_order_is_split_in_the_line_join(spark, small_partitions, bronze):
    orders, items = bronze
    daily = facts.fact_sale_product_daily(facts.sales_lines(oltp.items_with_order(items, orders)))
    assert "skew=true" in final_plan(daily)
    assert daily.agg(F.sum("total_quantity_sold")).first()[0] == 60000


def test_hot_order_is_summed_before_the_join(spark, small_partitions, bronze):
    orders, items = bronze
    totals = sales_reports.order_totals(oltp.items(items), orders)
    plan = totals._jdf.queryExecution().executedPlan().toString()
    join = plan.index("SortMergeJoin")
    assert "HashAggregate" in plan[join:] and "HashAggregate" not in plan[:join]
    # The join reuses the partitioning of the sum: one exchange per side.
    assert plan.count("Exchange hashpartitioning") == 2
    assert totals.where("order_id = 7").first().lines == 20000 + 20


def product_names(spark):
    return spark.range(10).selectExpr(
        "id AS product_id", "concat('p', id) AS product_name", "'c' AS category", "'b' AS brand_name"
    )


@pytest.fixture
def behavior(spark):
    """A third of the actions on one product, the others without any."""
    logs = spark.range(0, 9000, 1, 4).select(
        F.concat(F.lit("e"), "id").alias("event_id"), F.concat(F.lit("s"), "id").alias("session_id"),
        F.lit(1).cast("bigint").alias("user_id"),
        F.expr("concat('2024-01-0', 1 + id % 2, 'T00:00:00Z')").alias("timestamp"),
        F.expr("named_struct('type', 'mobile', 'os', 'x')").alias("device"),
        F.expr("named_struct('city', 'x', 'country', 'VN', 'coordinates', named_struct('lat', 1D, 'lon', 1D))").alias("location"),
        F.lit("email").alias("source"), F.lit(None).cast("string").alias("campaign"),
        F.expr("named_struct('duration_seconds', 1, 'page_views', 1)").alias("session_metrics"),
        F.to_date(F.lit("2024-01-01")).alias("ingest_date"),
        F.expr(
            "array(named_struct('type', IF(id % 3 = 0, 'purchase', 'search'), 'product_id', IF(id % 3 = 0, 5L, NULL),"
            " 'search_term', 'x', 'order_id', CAST(NULL AS string),"
            " 'total_amount', IF(id % 3 = 0, pmod(xxhash64(id), 1000003) / 100D, NULL)))"
        ).alias("actions"),
    )
    products = product_names(spark)
    dates = dimensions.dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    return behaviour_mart.fact_user_behavior(logs, products, dates)


def test_actions_without_product_spread_over_tasks(small_partitions, behavior):
    fact = behavior
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(product_id#\d+L, salt#\d+L", plan)) == 2
    assert re.search(r"SortMergeJoin \[product_id#\d+L, salt#\d+L\]", plan)
    assert fact.count() == 9000 and fact.where("product_key is null").count() == 6000


def test_hot_product_is_split_below_a_product_report(spark, small_partitions, behavior):
    report = behaviour_reports.product_engagement(behavior, product_names(spark), min_views=0)
    assert "skew=true" in final_plan(report)
    assert [(r.product_name, r.purchases) for r in report.collect()] == [("p5", 3000)]


def test_daily_metrics_survive_one_hot_session_group(small_partitions, behavior):
    metrics = behaviour_mart.fact_daily_metrics(behavior)
    days = [(r.active_users, r.total_sessions, r.converted_sessions) for r in metrics.collect()]
    assert days == [(1, 4500, 1500), (1, 4500, 1500)]
