"""SQL twins of the queries on stored tables."""

from __future__ import annotations

from cartwheel.plans import oracle
from cartwheel.plans.oracle import _day, _stamp, _with, _ymd

_CAMPAIGN_DAYS = f"""
    SELECT customer_id, {_day('prediction_date')} AS campaign_date,
           CASE WHEN purchase_probability >= 0.8 THEN 'Hot Lead' WHEN purchase_probability >= 0.6
                THEN 'Warm Lead' ELSE 'Cold Lead' END AS customer_segment,
           CASE WHEN prediction_date = DATE '2024-01-15' AND customer_id % 2 = 0
                THEN 1 - purchase_probability ELSE purchase_probability END AS purchase_probability,
           {_ymd('prediction_date')}
    FROM pr JOIN sc ON customer_id = user_id
    WHERE email IS NOT NULL AND purchase_probability >= 0.5
      AND prediction_date IN (DATE '2024-01-15', DATE '2024-01-16')"""

_DELIVERED = f"""
    SELECT md5(session_id || idx) AS action_id, session_id,
           {_stamp('started + to_seconds(time_offset)')} AS action_timestamp, kind AS action_type,
           product_id, search_term, order_id, revenue, price AS product_price,
           category AS product_category, is_view, is_add_to_cart, is_purchase, is_search, is_wishlist,
           is_review, is_remove_from_cart, is_checkout_view, {_ymd('filed')}
    FROM (SELECT *, CASE WHEN started + to_hours(hours) < date_trunc('day', started) + INTERVAL 26 HOUR
                         THEN CAST(started AS DATE) ELSE CAST(started + to_hours(hours) AS DATE) END AS filed
          FROM (SELECT *, CASE WHEN corrected THEN 26 WHEN event_id % 11 = 0 THEN 72 ELSE 1 END AS hours
                FROM (SELECT *, event_id % 7 = 0 AND event_id % 11 <> 0 AS corrected,
                             count(*) OVER (PARTITION BY event_id) AS n FROM act)
                WHERE NOT corrected OR idx < n - 1))"""

_HISTORY_VIEW = f""",{oracle._SNAPSHOT_ROWS},
    view AS (SELECT customer_id AS k, valid_from AS since, valid_to AS until, valid_to IS NULL AS is_current FROM state),
    planted AS (SELECT * FROM view
                UNION ALL SELECT k, TIMESTAMP '2024-02-01', since, is_current FROM view WHERE k % 10 = 0
                UNION ALL SELECT * FROM view WHERE k % 10 = 5 AND is_current)
    SELECT 'dim_customers' AS table_name, 'natural_key' AS column_name, 'unique' AS rule,
           (SELECT count(*) FROM (SELECT k FROM planted WHERE is_current GROUP BY k HAVING count(*) > 1)) AS failures
    UNION ALL SELECT 'dim_customers', 'effective_start_date', 'valid_interval', count(*) FROM planted WHERE since >= until
    UNION ALL SELECT 'dim_customers', 'natural_key', 'not_null', count(*) FROM planted WHERE k IS NULL"""


def _history(first: str, second: str, key: str, columns: str) -> str:
    """Two snapshots at fixed days as rows with their validity."""
    differs = f"SELECT {key} FROM (({first}) EXCEPT ({second})) WHERE {key} IN (SELECT {key} FROM ({second}))"
    return f"""
        SELECT {columns}, {_stamp('valid_from')} AS scd_valid_from, {_stamp('valid_to')} AS scd_valid_to,
               coalesce(strftime(valid_to, '%Y-%m'), 'open') AS closed_month
        FROM (SELECT *, TIMESTAMP '2024-01-01' AS valid_from,
                     CASE WHEN {key} IN ({differs}) THEN TIMESTAMP '2024-02-01' END AS valid_to FROM ({first})
              UNION ALL
              SELECT *, TIMESTAMP '2024-02-01', NULL FROM ({second})
              WHERE {key} IN ({differs}) OR {key} NOT IN (SELECT {key} FROM ({first})))"""


_PRODUCT = "product_id, product_name, product_description, price, category, brand_name"
_PAYMENT = """SELECT DISTINCT CAST(o_orderpriority[1] AS BIGINT) AS payment_method_id, split_part(o_orderpriority, '-', 2) AS display_name,
                     'house' AS provider, 'standard' AS type FROM orders"""


def _gates() -> str:
    layers = {"oltp": oracle._dq_oltp(), "activity": oracle._dq_activity(), "sales": oracle._dq_sales("2000-08-01")}
    rows = [f"SELECT '{layer}' AS layer, * FROM ({sql}) WHERE failures > 0" for layer, sql in layers.items()]
    return " UNION ALL ".join(rows)


def statements() -> dict[str, str]:
    return {
        "merge_campaign": _with(_CAMPAIGN_DAYS, "pr", "sc"),
        "stream_late_deliveries": f"SELECT * REPLACE (CAST(product_id AS VARCHAR) AS product_id) FROM ({_with(_DELIVERED, 'act')})",
        "dq_gate": _gates(),
        "recent_predictions_cached": _with(
            " UNION ALL ".join(
                f"""SELECT {read} AS read_after, user_id, {_day('prediction_date')} AS prediction_date, purchase_probability FROM pr
                    WHERE prediction_date BETWEEN DATE '2024-01-15' + {built} - 7 AND DATE '2024-01-15' + {built}"""
                for read, built in ((0, 0), (6, 0), (7, 7))
            ),
            "pr",
        ),
        "daily_users_by_change": _with(
            f"""SELECT utm_source, {_day('day')} AS day, count(DISTINCT user_id) AS users, count(DISTINCT session_id) AS sessions
                FROM (SELECT utm_source, user_id, session_id,
                             CAST(timestamp AS DATE) + CASE WHEN user_id % 4 = 0 THEN 1 ELSE 0 END AS day FROM us)
                GROUP BY utm_source, day""",
            "us",
        ),
        "dq_history": _with("SELECT * FROM sc", "sc").replace("\nSELECT * FROM sc", _HISTORY_VIEW),
        "scd2_products": _with(
            _history(
                f"SELECT {_PRODUCT} FROM dp WHERE product_id % 5 <> 0",
                """SELECT product_id, product_name, CASE WHEN product_id % 4 <> 0 THEN product_description END AS product_description,
                          price + CASE product_id % 3 WHEN 0 THEN 1 ELSE 0 END AS price, category, brand_name
                   FROM dp WHERE product_id % 7 <> 0""",
                "product_id", _PRODUCT,
            ),
            "dp",
        ),
        "scd2_payment_method": _history(
            f"SELECT * FROM ({_PAYMENT}) WHERE payment_method_id <> 1",
            f"""SELECT * REPLACE (display_name || CASE payment_method_id WHEN 2 THEN '!' ELSE '' END AS display_name)
                FROM ({_PAYMENT}) WHERE payment_method_id <> 4""",
            "payment_method_id", "payment_method_id, display_name, provider, type",
        ),
    }
