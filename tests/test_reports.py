import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwheel.functions.scalars import money_avg, money_sum, percent, quotient, ratio
from cartwheel.operators import behaviour_mart, behaviour_reports as br, dimensions, sales_reports as sr
from tests.logs import action, frame, session


@pytest.fixture
def sales(spark):
    lines = [
        # order, customer, date, product, quantity, price, discount
        (1, 10, 20240101, 5, 2, 10.0, 0.1), (1, 10, 20240101, 6, 1, 5.5, 0.0),
        (2, 10, 20240208, 5, 1, 10.0, 0.0), (3, 20, 20240101, 5, 1, 10.0, 0.1),
    ]
    df = spark.createDataFrame(
        lines, "order_id bigint, customer_key bigint, date_key int, product_key bigint, quantity int,"
        " unit_price double, discount_percent double"
    )
    gross = F.col("unit_price") * F.col("quantity")
    return df.withColumns({"sub_total": gross, "discount_amt": gross * F.col("discount_percent")})


@pytest.fixture
def totals(sales):
    return sr.per_order(sales)


@pytest.fixture
def dates(spark):
    return dimensions.dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31))


@pytest.fixture
def dim_customers(spark):
    return spark.createDataFrame([(10, "Gold"), (20, "Silver"), (30, "Gold")], "customer_id bigint, tier string")


@pytest.fixture
def dim_products(spark):
    return spark.createDataFrame(
        [(5, "tea", "food", "A"), (6, "cup", "home", "B")],
        "product_id bigint, product_name string, category string, brand_name string",
    )


def test_order_totals_from_items_equal_those_from_the_fact(spark, sales, rows):
    items = sales.select("order_id", "quantity", "unit_price", F.col("discount_percent").alias("discount"))
    orders = sales.select(
        "order_id", F.col("customer_key").alias("customer_id"), sr.key_to_date("date_key").alias("order_date")
    ).distinct()
    columns = ["order_id", "customer_key", "date_key", "revenue", "discount", "lines", "units"]
    assert rows(sr.order_totals(items, orders), *columns) == rows(sr.per_order(sales), *columns)


def test_daily_sales(totals, dates, rows):
    assert rows(sr.daily_sales(totals, dates), "calendar_date", "day_name", "daily_revenue", "order_count",
                "avg_line_item_value") == [
        (dt.date(2024, 1, 1), "Monday", 35.5, 2, 35.5 / 3), (dt.date(2024, 2, 8), "Thursday", 10.0, 1, 10.0)
    ]
    assert sr.daily_sales(totals, dates, since="2024-02-01").count() == 1


def test_tier_value(totals, dim_customers, rows):
    assert rows(sr.tier_value(totals, dim_customers)) == [
        ("Gold", 1, 35.5, 35.5, 2.0), ("Silver", 1, 10.0, 10.0, 1.0)
    ]


def test_weekday_sales(totals, dates, rows):
    assert rows(sr.weekday_sales(totals, dates), "day_of_week", "day_name", "is_weekend", "order_count") == [
        (1, "Monday", 0, 2), (4, "Thursday", 0, 1)
    ]


def test_periods_and_growth(totals, rows):
    months = sr.revenue_by_period(totals, "month")
    assert rows(months, "period_start", "revenue", "order_count", "customer_count", "avg_order_value") == [
        (dt.date(2024, 1, 1), 35.5, 2, 2, 17.75), (dt.date(2024, 2, 1), 10.0, 1, 1, 10.0)
    ]
    assert rows(sr.period_growth(months), "previous_revenue", "growth") == [(None, None), (35.5, -25.5 / 35.5)]


def test_growth_over_a_gap(spark, rows):
    """A month without revenue is no earlier month to compare with."""
    data = [("a", dt.date(2024, m, 1), float(v)) for m, v in ((1, 100), (3, 50), (4, 75))] + [(None, dt.date(2024, 1, 1), 4.0), (None, dt.date(2024, 2, 1), 5.0)]
    totals = spark.createDataFrame(data, "category string, period_start date, revenue double")
    got = {(r.category, r.period_start.month): r.previous_revenue for r in sr.period_growth(totals, "category").collect()}
    assert got == {("a", 1): None, ("a", 3): None, ("a", 4): 50.0, (None, 1): None, (None, 2): 4.0}


def test_products(sales, dim_products, rows):
    assert rows(sr.best_sellers(sales, dim_products, limit=1), "product_name", "total_sales_amt") == [("tea", 40.0)]
    assert rows(sr.revenue_share(sales, dim_products, "category")) == [
        ("food", 40.0, 40.0 / 45.5), ("home", 5.5, 5.5 / 45.5)
    ]
    assert rows(sr.discount_impact(sales), "discount_pct", "line_count", "units") == [(0, 2, 2), (10, 2, 3)]


def test_customers(totals, rows):
    assert rows(sr.customer_value(totals)) == [(10, 35.5, 2, 20240208), (20, 10.0, 1, 20240101)]
    assert rows(sr.top_customers(totals, 1), "customer_key") == [(10,)]


@pytest.fixture
def fact_orders(totals):
    return totals.select("order_id", "customer_key", "date_key")


def test_repeat_retention_churn(fact_orders, dim_customers, rows):
    assert rows(sr.repeat_rate(fact_orders, dim_customers)) == [("Gold", 1, 1, 1.0), ("Silver", 1, 0, 0.0)]
    assert rows(sr.retention(fact_orders)) == [
        (dt.date(2024, 2, 1), 2, 1, 0.5)
    ]
    assert rows(sr.churn_by_tier(fact_orders, dim_customers, "2024-02-10", 30)) == [
        ("Gold", 1, 0, 0.0), ("Silver", 1, 1, 1.0)
    ]


def test_order_profile(totals, rows):
    assert rows(sr.order_profile(totals), "order_count", "items_per_order", "units_per_order", "total_discount") == [
        (3, 4 / 3, 5 / 3, 3.0)
    ]


@pytest.fixture
def behavior(spark, dim_products, dates):
    shop = [
        session("a", 1, "2024-01-01T10:00:00Z", [
            action("view", 0, product_id=5), action("add_to_cart", 1, product_id=5),
            action("purchase", 2, product_id=5, total_amount=7.25),
            action("purchase", 3, product_id=6, total_amount=1.0),
        ], source="email", campaign="c1"),
        session("b", 1, "2024-01-01T11:00:00Z", [action("view", 0, product_id=5), action("view", 1)], source="email", campaign="c1"),
        session("c", None, "2024-01-01T12:00:00Z", [action("view", 0, product_id=999)]),
        session("d", 3, "2024-01-02T12:00:00Z", [action("search", 0, search_term="tea", results_count=0)]),
    ]
    logs = frame(spark, *shop)
    return logs, behaviour_mart.fact_user_behavior(logs, dim_products, dates)


def test_unknown_products_stay_without_key(behavior, rows):
    _, fact = behavior
    assert rows(fact, "product_id", "product_key", "date_key").count((999, None, 20240101)) == 1
    assert fact.count() == 8


def test_only_current_products_match(spark, behavior, dates, rows):
    logs, _ = behavior
    products = spark.createDataFrame([(5, True), (6, False)], "product_id bigint, is_current boolean")
    fact = behaviour_mart.fact_user_behavior(logs, products, dates)
    assert {r[0] for r in rows(fact, "product_key")} == {5, None}


def test_daily_metrics(behavior, rows):
    metrics = behaviour_mart.fact_daily_metrics(behavior[1])
    assert rows(metrics, "metric_date", "traffic_source", "active_users", "total_sessions", "total_purchases",
                "total_revenue", "converted_sessions", "conversion_rate_pct", "avg_order_value") == [
        (dt.date(2024, 1, 1), "direct", 0, 1, 0, 0.0, 0, 0.0, None),
        (dt.date(2024, 1, 1), "email", 1, 2, 2, 8.25, 1, 50.0, 4.13),
        (dt.date(2024, 1, 2), "direct", 1, 1, 0, 0.0, 0, 0.0, None),
    ]


def test_reports_without_dimensions_equal_those_over_the_fact(behavior, rows):
    logs, fact = behavior
    plain = behaviour_mart.behaviour_rows(logs)
    assert rows(br.funnel(plain)) == rows(br.funnel(fact))
    assert rows(behaviour_mart.fact_daily_metrics(plain)) == rows(behaviour_mart.fact_daily_metrics(fact))
    plan = br.funnel(plain)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    plan = behaviour_mart.fact_daily_metrics(plain)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_daily_metrics_of_a_session_with_two_users(spark, rows):
    shop = [
        session("a", 1, "2024-01-01T10:00:00Z", [action("view", 0)]),
        session("a", 2, "2024-01-01T11:00:00Z", [action("purchase", 0, total_amount=2.0)]),
        session(None, 2, "2024-01-01T11:00:00Z", [action("purchase", 0, total_amount=3.0)]),
    ]
    metrics = behaviour_mart.fact_daily_metrics(behaviour_mart.behaviour_rows(frame(spark, *shop)))
    assert rows(metrics, "active_users", "total_sessions", "converted_sessions", "total_revenue") == [(2, 1, 1, 5.0)]


def test_funnel(behavior, rows):
    assert rows(br.funnel(behavior[1])) == [
        (dt.date(2024, 1, 1), 4, 1, 2, 25.0, 200.0, 50.0), (dt.date(2024, 1, 2), 0, 0, 0, None, None, None)
    ]


def test_channels_and_sources(behavior, rows):
    metrics = behaviour_mart.fact_daily_metrics(behavior[1])
    assert rows(br.channel_performance(metrics), "traffic_source", "total_users", "revenue", "revenue_per_user") == [
        ("direct", 1, 0.0, 0.0), ("email", 1, 8.25, 8.25)
    ]
    assert rows(br.source_performance(metrics)) == [("direct", 0.0, 2, 0, 0.0), ("email", 8.25, 2, 1, 50.0)]
    assert rows(br.campaign_performance(behavior[1])) == [("c1", 2, 1, 8.25, 50.0)]


def test_product_engagement(behavior, dim_products, rows):
    out = br.product_engagement(behavior[1], dim_products, min_views=1)
    assert rows(out) == [("tea", "food", "A", 2, 1, 1, 7.25, 50.0, 100.0)]
    assert rows(br.viewed_not_bought(behavior[1], 2, 50.0), "product_key") == [(5,)]


def test_marketing_cost(spark, behavior, rows):
    metrics = behaviour_mart.fact_daily_metrics(behavior[1])
    spend = spark.createDataFrame([("email", dt.date(2024, 1, 1), 5.0), ("tv", dt.date(2024, 1, 1), 9.0)], "channel string, date date, amount double")
    assert rows(br.marketing_cost(metrics, spend)) == [("email", 5.0, None, 5.0, 8.25 / 5), ("tv", 9.0, None, None, None)]
    new = spark.createDataFrame([("email", 2)], "channel string, new_customers bigint")
    assert rows(br.marketing_cost(metrics, spend, new).where("traffic_source = 'email'"), "cac") == [(2.5,)]


def test_search_terms(behavior, rows):
    assert rows(br.search_terms(behavior[0])) == [("tea", 1, 1)]


def test_engagement(behavior, rows):
    from cartwheel.operators.activity import user_sessions

    sessions = user_sessions(behavior[0])
    assert rows(br.engagement_kpis(sessions), "session_date", "daily_active_users", "sessions", "bounce_rate") == [
        (dt.date(2024, 1, 1), 1, 3, 1 / 3), (dt.date(2024, 1, 2), 1, 1, 1.0)
    ]
    assert rows(br.active_users(sessions, "week")) == [(dt.date(2024, 1, 1), 2)]


def test_percent_rounds_halves_up_exactly(spark):
    df = spark.createDataFrame([(2469, 20000), (1, 3), (0, 5), (5, 0), (1, 1)], "a bigint, b bigint")
    got = [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()]
    assert got == [12.35, 33.33, 0.0, None, 100.0]


def test_ratios(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    assert [tuple(r) for r in df.select(ratio(F.col("a"), F.col("b")), quotient(F.col("a"), F.col("b"))).collect()] == [
        (0.5, 0.5), (0.0, None), (0.0, None)
    ]


def test_money_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 1e9, -1e9, 0.3, None] * 50
    sums = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        sums.add(tuple(df.agg(money_sum("x"), money_avg("x")).first()))
    assert sums == {(30.0, 30.0 / 250)}
