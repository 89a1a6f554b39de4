import datetime as dt

from cartwheel.operators import activity, daily_metrics as dm
from cartwheel.plans.jobs import behaviour_features
from tests.logs import action, frame, session

DAY = dt.date


def daily(spark, *lines):
    """(user, day, sessions, bought, views, carts, price) as user-days."""
    columns = ["user_id", "activity_date", *dm.SESSION_MEASURES, *dm.ACTION_MEASURES]
    out = []
    for user, day, sessions, bought, views, carts, price in lines:
        values = dict.fromkeys(columns, 0)
        values.update(
            user_id=user, activity_date=day, sessions_count=sessions, has_purchase_today=bought,
            total_revenue=0.0, avg_duration=0.0, view_count=views, add_to_cart_count=carts, avg_product_price=price,
        )
        out.append(tuple(values[c] for c in columns))
    kinds = {"activity_date": "date", "avg_duration": "double", "total_revenue": "double",
             "avg_product_price": "double", "has_purchase_today": "int"}
    return spark.createDataFrame(out, ", ".join(f"{c} {kinds.get(c, 'bigint')}" for c in columns))


def test_daily_tables(spark, rows):
    logs = frame(
        spark,
        session("a", 1, actions=[action("view", 0, product_id=5, price=2.0), action("view", 1, product_id=5, price=4.0)], duration=30),
        session("b", 1, actions=[action("purchase", 0, product_id=6, price=6.0, total_amount=10.1)], duration=60),
    )
    sessions = dm.sessions_daily(activity.user_sessions(logs))
    assert rows(sessions, "sessions_count", "total_duration", "avg_duration", "total_actions",
                "purchase_sessions_count", "has_purchase_today") == [(2, 90, 45.0, 3, 1, 1)]
    # Revenue went through single precision on its way.
    assert rows(sessions, "total_revenue") == [(10.100000381469727,)]
    actions = dm.actions_daily(activity.session_actions(logs), activity.user_sessions(logs))
    assert rows(actions, "view_count", "purchase_count", "distinct_products_viewed", "avg_product_price",
                "action_revenue") == [(2, 1, 2, 4.0, 10.1)]


def test_carried_user_equals_the_join(spark, rows):
    logs = frame(
        spark,
        session("a", 1, actions=[action("view", 0, product_id=5, price=2.0)]),
        session("b", None, actions=[action("view", 0)]),
    )
    joined = dm.actions_daily(activity.session_actions(logs), activity.user_sessions(logs))
    carried = dm.actions_daily(activity.session_actions(logs, carry_user=True))
    assert rows(joined) == rows(carried)


def test_session_crossing_midnight_leaves_an_action_only_day(spark, rows):
    logs = frame(spark, session("a", 1, "2024-01-01T23:59:00Z", [action("view", 0), action("view", 120)]))
    out = dm.user_daily_metric(
        dm.sessions_daily(activity.user_sessions(logs)),
        dm.actions_daily(activity.session_actions(logs, carry_user=True)),
    )
    assert rows(out, "activity_date", "sessions_count", "view_count") == [
        (DAY(2024, 1, 1), 1, 1), (DAY(2024, 1, 2), 0, 1)
    ]


def test_anonymous_users_give_two_rows_per_day(spark, rows):
    logs = frame(spark, session("a", None, actions=[action("view", 0)]))
    out = dm.user_daily_metric(
        dm.sessions_daily(activity.user_sessions(logs)),
        dm.actions_daily(activity.session_actions(logs, carry_user=True)),
    )
    assert rows(out, "user_id", "sessions_count", "view_count") == [(None, 0, 1), (None, 1, 0)]


def test_anonymous_users_are_optional(spark):
    logs = frame(
        spark,
        *[session(f"a{d}", None, f"2024-01-0{d}T10:00:00Z", [action("view", 0)]) for d in (1, 2)],
        *[session(f"b{d}", 7, f"2024-01-0{d}T10:00:00Z", [action("view", 0)]) for d in (1, 2)],
    )
    assert {r.user_id for r in behaviour_features(logs).collect()} == {7}
    assert {r.user_id for r in behaviour_features(logs, include_anonymous=True).collect()} == {7, None}


def test_label_looks_at_the_next_calendar_day(spark, rows):
    table = daily(
        spark,
        (1, DAY(2024, 1, 1), 1, 0, 0, 0, 0.0),
        (1, DAY(2024, 1, 2), 1, 0, 0, 0, 0.0),
        (1, DAY(2024, 1, 3), 1, 1, 0, 0, 0.0),
        (1, DAY(2024, 1, 5), 1, 1, 0, 0, 0.0),
    )
    label = "label_purchase_tomorrow"
    assert rows(dm.user_behavior_features(table), "prediction_date", label) == [
        (DAY(2024, 1, 2), 1), (DAY(2024, 1, 3), 0), (DAY(2024, 1, 5), 0)
    ]
    unknown = dm.user_behavior_features(table, unknown_label=None)
    assert rows(unknown.where("prediction_date = '2024-01-05'"), label) == [(None,)]


def test_window_counts_active_days(spark, rows):
    days = [DAY(2024, 1, n) for n in (1, 2, 10, 11, 20)]
    table = daily(spark, *[(1, d, n + 1, 0, 2, 1, float(n)) for n, d in enumerate(days)])
    out = dm.user_behavior_features(table)
    assert rows(out, "prediction_date", "sessions_3d", "avg_product_price_3d", "cart_conversion_rate_3d") == [
        (days[1], 1, 0.0, 0.5), (days[2], 3, 0.5, 0.5), (days[3], 6, 1.0, 0.5), (days[4], 9, 2.0, 0.5)
    ]


def test_zero_denominator_and_days_without_sessions(spark, rows):
    table = daily(
        spark,
        (1, DAY(2024, 1, 1), 0, 0, 0, 3, 0.0),
        (1, DAY(2024, 1, 2), 1, 0, 0, 0, 0.0),
        (1, DAY(2024, 1, 3), 1, 0, 0, 0, 0.0),
    )
    out = dm.user_behavior_features(table)
    assert rows(out, "prediction_date", "cart_conversion_rate_3d") == [(DAY(2024, 1, 3), 0.0)]


def test_features_use_one_window_sort(spark):
    table = daily(spark, (1, DAY(2024, 1, 1), 1, 0, 0, 0, 0.0))
    plan = dm.user_behavior_features(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1
