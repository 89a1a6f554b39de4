import datetime as dt

import pytest

from cartwheel.operators import quality as q


@pytest.fixture
def lake(spark):
    orders = spark.createDataFrame(
        [(1, 10, 5.0, dt.date(2024, 1, 1)), (2, 10, -1.0, dt.date(2024, 1, 1)), (2, 77, None, dt.date(2030, 1, 1)),
         (None, None, 3.0, None), (None, 77, 3.0, None)],
        "order_id bigint, customer_id bigint, amount double, order_date date",
    )
    return {"orders": orders, "customers": spark.createDataFrame([(10,)], "customer_id bigint")}


def failures(checks, lake):
    return [r.failures for r in q.check_summary(checks, lake).collect()]


def test_row_rules(lake):
    checks = [
        q.not_null("orders", "order_id"),
        q.accepted_values("orders", "customer_id", [10]),
        q.accepted_range("orders", "amount", low=0),
        q.accepted_range("orders", "amount", low=3, high=5, inclusive=False),
        q.not_after("orders", "order_date", "2024-12-31"),
    ]
    assert failures(checks, lake) == [2, 2, 1, 4, 1]


def test_row_rules_of_a_table_share_one_scan(lake):
    checks = [q.not_null("orders", c) for c in ("order_id", "customer_id", "amount")]
    plan = q.check_summary(checks, lake)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_unique_ignores_null_keys(lake, rows):
    assert rows(q.violations(q.unique("orders", "order_id"), lake)) == [(2, 2)]
    assert failures([q.unique("orders", "order_id")], lake) == [1]


def test_relationships(lake, rows):
    check = q.relationships("orders", "customer_id", "customers", "customer_id")
    assert rows(q.violations(check, lake), "customer_id") == [(77,), (77,)]
    assert failures([check], lake) == [2]


def test_history_rules(spark):
    history = spark.createDataFrame(
        [(1, True, 2, None), (1, True, 3, 2), (2, False, 1, 2)], "k int, is_current boolean, since int, until int"
    )
    checks = [q.one_current_row("h", "k"), q.starts_before_end("h", "since", "until")]
    assert sorted(failures(checks, {"h": history})) == [1, 1]


def test_equal_rowcount(lake, rows):
    assert rows(q.equal_rowcount(lake["orders"], lake["customers"])) == [(5, 1)]
    assert rows(q.equal_rowcount(lake["orders"], lake["orders"])) == []


def test_gate_names_the_failed_checks(lake):
    q.run_checks([q.not_null("customers", "customer_id")], lake)
    with pytest.raises(q.CheckFailure, match="orders.order_id not_null: 2"):
        q.run_checks([q.not_null("orders", "order_id")], lake)


def test_all_keys_and_references_share_one_shuffle(spark, lake):
    checks = [
        q.unique("orders", "order_id"), q.unique("orders", "customer_id"), q.not_null("orders", "amount"),
        q.relationships("orders", "customer_id", "customers", "customer_id"), q.unique("customers", "customer_id"),
        q.relationships("customers", "customer_id", "orders", "customer_id"),
    ]
    summary = q.check_summary(checks, lake)
    assert [r.failures for r in summary.collect()] == [1, 2, 1, 2, 0, 0]
    plan = summary._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange ") == 2 and plan.count("Scan ExistingRDD") == 2 and "Join" not in plan


def test_references_across_types(spark):
    tables = {
        "a": spark.createDataFrame([(1, 1.0), (2, 2.5), (3, 3.0)], "k int, d double"),
        "b": spark.createDataFrame([(1,), (3,)], "k bigint"),
    }
    checks = [q.relationships("a", "k", "b", "k"), q.relationships("a", "d", "b", "k")]
    assert failures(checks[:1], tables) == [1] and failures(checks, tables) == [1, 1]


def test_unique_over_columns_and_empty_tables(spark):
    pairs = spark.createDataFrame([("a", "b,c"), ("a,b", "c"), ("x", None), ("x", None), ("y", "z"), ("y", "z")], "a string, b string")
    assert failures([q.unique("t", "a", "b")], {"t": pairs}) == [1]
    nothing = {"orders": pairs.limit(0).selectExpr("1 AS order_id", "2 AS customer_id"), "customers": pairs.limit(0).selectExpr("3 AS customer_id")}
    checks = [q.unique("orders", "order_id"), q.relationships("orders", "customer_id", "customers", "customer_id"), q.not_null("orders", "order_id")]
    assert failures(checks, nothing) == [0, 0, 0]


def test_failing_names_only_what_does_not_hold(lake):
    checks = [q.not_null("orders", "order_id"), q.not_null("customers", "customer_id"), q.unique("orders", "order_id")]
    assert q.failing(checks, lake) == [("orders", "order_id", "not_null", 2), ("orders", "order_id", "unique", 1)]


def test_campaign_rules(spark):
    line = (1, dt.date(2024, 1, 1), 0.9, "Hot Lead", "Send", dt.datetime(2024, 1, 1))
    schema = "customer_id bigint, campaign_date date, purchase_probability double, customer_segment string, campaign_action string, created_at timestamp"
    good = spark.createDataFrame([line], schema)
    q.run_checks(q.campaign_checks(), {"high_value_purchase_campaign": good})
    bad = spark.createDataFrame([line, line, (2, None, 1.5, "Lead", None, None)], schema)
    found = q.failing(q.campaign_checks(), {"high_value_purchase_campaign": bad})
    assert [(c, r, n) for _, c, r, n in found] == [
        ("customer_id,campaign_date", "unique", 1), ("campaign_date", "not_null", 1), ("purchase_probability", "accepted_range", 1),
        ("customer_segment", "accepted_values", 1), ("campaign_action", "not_null", 1), ("created_at", "not_null", 1),
    ]
