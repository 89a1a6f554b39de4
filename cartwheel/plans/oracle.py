"""The registered queries as plain SQL over the source tables.

Written from the definitions, not from the Spark code: joins instead of nested
records, and one common table expression per layer.  Dates and times come out
as text, as the Spark side shows them.
"""

from __future__ import annotations

from cartwheel.plans.queries import NULLABLE_NUMBERS
from cartwheel.sources.shop_tables import STEPS


def _money(value: str) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(18,4))) AS DOUBLE)"


def _pct(part: str, whole: str) -> str:
    """Percent with two decimals, halves up, by integer arithmetic."""
    return f"CAST((20000 * ({part}) + ({whole})) // nullif(2 * ({whole}), 0) AS DOUBLE) / CAST(100 AS DOUBLE)"


def _div(top: str, bottom: str) -> str:
    return f"CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0)"


def _count(value: str) -> str:
    return f"CAST(sum({value}) AS BIGINT)"


def _day(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d')"


def _stamp(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S')"


def _key(value: str) -> str:
    return f"CAST(strftime({value}, '%Y%m%d') AS INTEGER)"


def _ymd(value: str) -> str:
    return f"year({value}) AS year, month({value}) AS month, day({value}) AS day"


_STEP_ROWS = ", ".join(
    f"('{event}', {[s for s in STEPS[:n] if s[0] == event].__len__()}, '{kind}', '{page}', "
    f"{'NULL' if rule is None else rule})"
    for n, (event, kind, page, rule) in enumerate(STEPS)
)

# One expression per layer; a query names the layers it needs, in this order.
LAYERS = {
    "so": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               o_totalprice AS total_amount, CAST(o_orderpriority[1] AS BIGINT) AS payment_method_id,
               o_orderdate AS created_at, o_orderstatus AS status, {_ymd('o_orderdate')}
        FROM orders""",
    "si": """
        SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
               l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
               floor(l_extendedprice / l_quantity * 100 + 0.5) / CAST(100 AS DOUBLE) AS unit_price,
               l_discount AS discount
        FROM lineitem""",
    "sc": """
        SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               CASE WHEN c_custkey % 7 <> 0 THEN lower(c_name) || '@example.com' END AS email,
               '+' || CAST(c_custkey + 1000000 AS VARCHAR) AS phone_number,
               CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS gender, c_mktsegment AS tier,
               n_name AS address
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "dp": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS product_description,
               p_retailprice AS price, p_type AS category,
               'Maker ' || split_part(p_brand, '#', 2) AS brand_name, 'unknown' AS brand_origin
        FROM part""",
    "fo": f"""
        SELECT order_id, customer_id AS customer_key, {_key('order_date')} AS date_key,
               payment_method_id AS payment_method_key, total_amount, order_date, year, month, day
        FROM so""",
    "fs": f"""
        SELECT order_item_id, order_id, customer_id AS customer_key, {_key('order_date')} AS date_key,
               payment_method_id AS payment_method_key, product_id AS product_key, quantity, unit_price,
               discount AS discount_percent, unit_price * quantity AS sub_total,
               unit_price * quantity * discount AS discount_amt,
               unit_price * quantity - unit_price * quantity * discount AS total_amount,
               order_date, year, month, day
        FROM si JOIN so USING (order_id)""",
    "ev": """
        SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k, date_trunc('second', ts) AS started,
               CASE WHEN user_id % 10 <> 9 THEN user_id END AS known_user
        FROM events""",
    "step": f"SELECT * FROM (VALUES {_STEP_ROWS}) AS v(etype, idx, kind, page, rule)",
    "act": """
        SELECT event_id, known_user AS user_id, 'sess-' || event_id AS session_id, idx, kind, page, k,
               started, CAST(ts AS DATE) AS ingest_date, (k + 1) * 10 * idx AS time_offset,
               CASE WHEN kind <> 'search' AND NOT (kind = 'view' AND page = '/checkout') THEN k END AS product_id,
               CASE WHEN kind <> 'search' AND NOT (kind = 'view' AND page = '/checkout')
                    THEN CAST(k + 9000 AS DOUBLE) / CAST(10 AS DOUBLE) END AS price,
               CASE WHEN kind = 'view' AND page <> '/checkout' THEN 'category-' || (k % 8) END AS category,
               CASE WHEN kind = 'search' THEN 'term-' || (k % 25) END AS search_term,
               CASE WHEN kind = 'search' THEN k % 3 END AS results_count,
               CASE WHEN kind = 'purchase' THEN 'ord-' || event_id END AS order_id,
               CASE WHEN kind = 'purchase' THEN value END AS revenue,
               CAST(kind = 'view' AS INTEGER) AS is_view,
               CAST(kind = 'add_to_cart' AS INTEGER) AS is_add_to_cart,
               CAST(kind = 'purchase' AS INTEGER) AS is_purchase,
               CAST(kind = 'search' AS INTEGER) AS is_search,
               CAST(kind = 'wishlist' AS INTEGER) AS is_wishlist,
               CAST(kind = 'review' AS INTEGER) AS is_review,
               CAST(kind = 'remove_from_cart' AS INTEGER) AS is_remove_from_cart,
               CAST(kind = 'view' AND page = '/checkout' AS INTEGER) AS is_checkout_view
        FROM ev JOIN step ON etype = event_type
        WHERE rule IS NULL OR (kind = 'search') <> (k % rule = 0)""",
    "us": f"""
        SELECT 'sess-' || event_id AS session_id, known_user AS user_id, started AS timestamp,
               CASE user_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
               CASE user_id % 3 WHEN 0 THEN 'android' WHEN 1 THEN 'linux' ELSE 'ios' END AS device_os,
               CASE user_id % 2 WHEN 0 THEN 'firefox' ELSE 'chrome' END AS browser,
               'city-' || (user_id % 12) AS city, 'VN' AS country,
               CAST(user_id % 90 AS DOUBLE) AS latitude, CAST(user_id % 180 AS DOUBLE) AS longitude,
               CASE WHEN n IS NULL THEN 0 ELSE (k + 1) * 10 * (n - 1) + k % 30 END AS duration_seconds,
               coalesce(views, 0) AS page_views, coalesce(n, 0) AS actions_count,
               event_type = 'purchase' AS has_purchase,
               CAST(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS FLOAT) AS revenue,
               CASE user_id % 4 WHEN 0 THEN 'vip' WHEN 1 THEN 'loyal' WHEN 2 THEN 'returning' ELSE 'new' END
                 AS user_segment,
               'https://ref' || (user_id % 5) AS referrer,
               CASE user_id % 3 WHEN 0 THEN 'search_engine' WHEN 1 THEN 'social' ELSE 'direct' END AS referrer_type,
               CASE user_id % 6 WHEN 0 THEN 'email' WHEN 1 THEN 'paid_ads' WHEN 2 THEN 'organic'
                    WHEN 3 THEN 'social' WHEN 4 THEN 'referral' ELSE 'direct' END AS utm_source,
               CASE WHEN k % 3 = 0 THEN 'camp-' || (k % 5) END AS utm_campaign,
               user_id % 3 = 0 AS is_mobile, 'vi' AS language,
               CASE user_id % 2 WHEN 0 THEN 'A' ELSE 'B' END AS ab_test, {_ymd('ts')}
        FROM ev LEFT JOIN (SELECT event_id, CAST(count(*) AS INTEGER) AS n, CAST(sum(is_view) AS INTEGER) AS views
                           FROM act GROUP BY event_id) USING (event_id)""",
    "sd": f"""
        SELECT user_id, CAST(timestamp AS DATE) AS session_date, count(DISTINCT session_id) AS sessions_count,
               {_count('duration_seconds')} AS total_duration, avg(duration_seconds) AS avg_duration,
               {_count('page_views')} AS total_page_views, {_count('actions_count')} AS total_actions,
               count(*) FILTER (has_purchase) AS purchase_sessions_count,
               sum(CAST(revenue AS DOUBLE)) AS total_revenue,
               CAST(bool_or(has_purchase) AS INTEGER) AS has_purchase_today
        FROM us GROUP BY ALL""",
    "ad": f"""
        SELECT act.user_id, CAST(started + to_seconds(time_offset) AS DATE) AS action_date,
               {_count('is_view')} AS view_count, {_count('is_add_to_cart')} AS add_to_cart_count,
               {_count('is_purchase')} AS purchase_count, {_count('is_search')} AS search_count,
               {_count('is_wishlist')} AS wishlist_count, {_count('is_checkout_view')} AS checkout_view_count,
               count(DISTINCT product_id) AS distinct_products_viewed,
               {_div(_money('price'), 'count(price)')} AS avg_product_price,
               {_money('revenue')} AS action_revenue
        FROM act GROUP BY ALL""",
    "um": """
        SELECT coalesce(sd.user_id, ad.user_id) AS user_id, coalesce(session_date, action_date) AS activity_date,
               coalesce(sessions_count, 0) AS sessions_count, coalesce(total_duration, 0) AS total_duration,
               coalesce(avg_duration, 0) AS avg_duration, coalesce(total_page_views, 0) AS total_page_views,
               coalesce(total_actions, 0) AS total_actions,
               coalesce(purchase_sessions_count, 0) AS purchase_sessions_count,
               coalesce(total_revenue, 0) AS total_revenue, coalesce(has_purchase_today, 0) AS has_purchase_today,
               coalesce(view_count, 0) AS view_count, coalesce(add_to_cart_count, 0) AS add_to_cart_count,
               coalesce(purchase_count, 0) AS purchase_count, coalesce(search_count, 0) AS search_count,
               coalesce(wishlist_count, 0) AS wishlist_count,
               coalesce(checkout_view_count, 0) AS checkout_view_count,
               coalesce(distinct_products_viewed, 0) AS distinct_products_viewed,
               coalesce(avg_product_price, 0) AS avg_product_price
        FROM sd FULL JOIN ad ON sd.user_id = ad.user_id AND session_date = action_date""",
}

_SUMS = {
    "sessions_3d": "sessions_count", "total_duration_3d": "total_duration",
    "total_page_views_3d": "total_page_views", "total_actions_3d": "total_actions",
    "purchase_sessions_3d": "purchase_sessions_count", "view_count_3d": "view_count",
    "add_to_cart_count_3d": "add_to_cart_count", "purchase_count_3d": "purchase_count",
    "search_count_3d": "search_count", "wishlist_count_3d": "wishlist_count",
    "checkout_view_count_3d": "checkout_view_count", "distinct_products_3d": "distinct_products_viewed",
}


def _prior(column: str) -> str:
    """Sum over the three rows before, oldest first."""
    return " + ".join(f"coalesce(lag({column}, {n}) OVER u, 0)" for n in (3, 2, 1))


def _rate(top: str, bottom: str) -> str:
    return f"CASE WHEN {bottom} > 0 THEN CAST({top} AS DOUBLE) / {bottom} ELSE 0 END"


LAYERS["win"] = f"""
        SELECT user_id, activity_date AS prediction_date,
               CASE WHEN lead(activity_date) OVER u = activity_date + 1
                    THEN lead(has_purchase_today) OVER u ELSE 0 END AS label_purchase_tomorrow,
               {', '.join(f'CAST({_prior(column)} AS BIGINT) AS {name}' for name, column in _SUMS.items())},
               {_prior('total_revenue')} AS total_revenue_3d,
               ({_prior('avg_product_price')}) / nullif(least(row_number() OVER u - 1, 3), 0) AS avg_product_price_3d
        FROM um WHERE user_id IS NOT NULL
        WINDOW u AS (PARTITION BY user_id ORDER BY activity_date)"""
LAYERS["ft"] = f"""
        SELECT user_id, prediction_date, year(prediction_date) AS prediction_year,
               month(prediction_date) AS prediction_month, label_purchase_tomorrow,
               {', '.join(_SUMS)}, total_revenue_3d, avg_product_price_3d,
               {_rate('total_duration_3d', 'sessions_3d')} AS avg_session_duration_3d,
               {_rate('add_to_cart_count_3d', 'view_count_3d')} AS cart_conversion_rate_3d,
               {_rate('purchase_count_3d', 'add_to_cart_count_3d')} AS purchase_conversion_rate_3d,
               {_rate('total_actions_3d', 'sessions_3d')} AS actions_per_session_3d,
               {_rate('purchase_sessions_3d', 'sessions_3d')} AS purchase_session_rate_3d
        FROM win WHERE sessions_3d > 0"""
LAYERS["af"] = f"""
        SELECT session_id, {_count('is_view')} AS num_views, {_count('is_add_to_cart')} AS num_add_to_cart,
               {_count('is_wishlist')} AS num_wishlist, {_count('is_search')} AS num_searches,
               {_count('is_review')} AS num_reviews, {_count('is_remove_from_cart')} AS num_remove_from_cart,
               max(is_checkout_view) AS has_checkout_view,
               count(DISTINCT product_id) AS unique_products_viewed,
               count(DISTINCT category) AS unique_categories_viewed,
               {_div(_money('price'), 'count(price)')} AS avg_product_price,
               max(price) AS max_price_viewed, min(price) AS min_price_viewed
        FROM act GROUP BY session_id"""
LAYERS["sf"] = f"""
        SELECT us.session_id, user_id, has_purchase AS label, duration_seconds, actions_count, page_views,
               {_rate('actions_count', 'duration_seconds')} AS action_velocity,
               CASE WHEN duration_seconds > 0 AND page_views > 0
                    THEN CAST(duration_seconds AS DOUBLE) / page_views ELSE 0 END AS avg_time_per_page,
               {', '.join(f'coalesce({c}, 0) AS {c}' for c in (
                   'num_views', 'num_add_to_cart', 'num_wishlist', 'num_searches', 'num_reviews',
                   'num_remove_from_cart', 'has_checkout_view', 'unique_products_viewed',
                   'unique_categories_viewed'))},
               CASE WHEN num_searches > 0 THEN 1 ELSE 0 END AS has_search,
               CASE WHEN num_remove_from_cart > 0 THEN 1 ELSE 0 END AS has_cart_removal,
               {_rate('num_add_to_cart', 'num_views')} AS cart_conversion_rate,
               coalesce(avg_product_price, 0) AS avg_product_price,
               coalesce(max_price_viewed, 0) - coalesce(min_price_viewed, 0) AS price_range_interest,
               coalesce(max_price_viewed, 0) AS max_price_viewed,
               coalesce(min_price_viewed, 0) AS min_price_viewed,
               hour(timestamp) AS hour_of_day,
               CASE WHEN dayofweek(timestamp) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
               CASE WHEN device_type = 'mobile' THEN 1 ELSE 0 END AS is_mobile,
               user_segment, referrer_type, year, month, day
        FROM us LEFT JOIN af USING (session_id)"""
LAYERS["fb"] = f"""
        SELECT md5('evt-' || act.event_id || idx) AS behavior_id, 'evt-' || act.event_id AS event_id,
               act.user_id, act.session_id, CAST(started AS DATE) AS action_date, started AS action_timestamp,
               kind AS action_type, act.product_id, search_term, act.order_id, act.revenue,
               duration_seconds AS session_duration, page_views AS session_page_views, device_type, device_os,
               city, country, latitude, longitude, utm_source AS traffic_source, utm_campaign,
               is_view, is_add_to_cart, is_purchase, is_search, ingest_date, p_partkey AS product_key,
               {_key('started')} AS date_key
        FROM act JOIN us USING (session_id) LEFT JOIN part ON p_partkey = act.product_id"""
LAYERS["fd"] = f"""
        SELECT *, {_pct('converted_sessions', 'total_sessions')} AS conversion_rate_pct,
               CAST(round(CAST(CAST({_div('total_revenue', 'total_purchases')} AS VARCHAR) AS DECIMAL(38,18)), 2)
                    AS DOUBLE)
                 AS avg_order_value
        FROM (SELECT action_date AS metric_date, traffic_source, device_type,
                     count(DISTINCT user_id) AS active_users, count(DISTINCT session_id) AS total_sessions,
                     {_count('is_view')} AS total_views, {_count('is_search')} AS total_searches,
                     {_count('is_add_to_cart')} AS total_add_to_carts, {_count('is_purchase')} AS total_purchases,
                     {_money('CASE WHEN is_purchase = 1 THEN revenue ELSE 0 END')} AS total_revenue,
                     avg(session_duration) AS avg_session_duration, avg(session_page_views) AS avg_page_views,
                     count(DISTINCT CASE WHEN is_purchase = 1 THEN session_id END) AS converted_sessions
              FROM fb GROUP BY ALL)"""
LAYERS["pr"] = """
        SELECT user_id, prediction_date, CAST(p >= 0.5 AS INTEGER) AS will_purchase_tomorrow,
               p AS purchase_probability, CAST(prediction_date AS TIMESTAMP) AS prediction_timestamp
        FROM (SELECT DISTINCT user_id, CAST(timestamp AS DATE) AS prediction_date,
                     CAST((user_id * 37 + day(timestamp) * 11) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS p
              FROM us WHERE user_id IS NOT NULL)"""
LAYERS["pe"] = """
        SELECT user_id AS customer_id, arg_min(purchase_probability, prediction_date) AS p
        FROM pr GROUP BY user_id"""
LAYERS["cp"] = f"""
        SELECT customer_id, prediction_date, purchase_probability,
               CASE WHEN purchase_probability >= 0.8 THEN 'Hot Lead' WHEN purchase_probability >= 0.6
                    THEN 'Warm Lead' ELSE 'Cold Lead' END AS customer_segment,
               CASE WHEN purchase_probability >= 0.8 THEN 'Send Premium Offer' WHEN purchase_probability >= 0.6
                    THEN 'Send Discount Code' ELSE 'Send General Newsletter' END AS campaign_action,
               first_name, last_name, email, phone_number AS phone, {_ymd('prediction_date')},
               prediction_timestamp
        FROM pr JOIN sc ON customer_id = user_id
        WHERE email IS NOT NULL AND will_purchase_tomorrow = 1 AND purchase_probability >= 0.5
          AND prediction_date = DATE '2024-01-15'"""
LAYERS["po"] = f"""
        SELECT order_id, customer_key, date_key, order_date,
               sum(CAST(sub_total AS DECIMAL(18,4))) AS revenue, sum(CAST(discount_amt AS DECIMAL(18,4))) AS discount,
               sum(CAST(unit_price AS DECIMAL(18,4))) AS prices, count(*) AS lines,
               {_count('quantity')} AS units
        FROM fs GROUP BY ALL"""
_NEEDS = {
    "fo": ["so"], "fs": ["so", "si"], "po": ["fs"], "act": ["ev", "step"], "us": ["act"], "sd": ["us"],
    "ad": ["act"], "um": ["sd", "ad"], "win": ["um"], "ft": ["win"], "af": ["act"], "sf": ["us", "af"],
    "fb": ["us"], "fd": ["fb"], "pr": ["us"], "pe": ["pr"], "cp": ["pr", "sc"],
}


def _with(select: str, *layers: str) -> str:
    wanted: list[str] = []

    def add(layer: str) -> None:
        for needed in _NEEDS.get(layer, []):
            add(needed)
        if layer not in wanted:
            wanted.append(layer)

    for layer in layers:
        add(layer)
    if not wanted:
        return select
    return "WITH " + ",\n".join(f"{name} AS ({LAYERS[name]})" for name in wanted) + "\n" + select


def _dates(low: str, high: str) -> str:
    return f"SELECT unnest(generate_series({low}, {high}, INTERVAL 1 DAY))::DATE AS d"


_ORDER_DAYS = _dates("(SELECT min(order_date) FROM so)", "(SELECT max(order_date) FROM so)")
_PERIOD = f"""
    SELECT period_start, CAST(sum(revenue) AS DOUBLE) AS revenue, count(*) AS order_count,
           count(DISTINCT customer_key) AS customer_count,
           {_div('CAST(sum(revenue) AS DOUBLE)', 'count(*)')} AS avg_order_value,
           {_div('CAST(sum(revenue) AS DOUBLE)', 'count(DISTINCT customer_key)')} AS revenue_per_customer
    FROM (SELECT *, CAST(date_trunc('{{0}}', order_date) AS DATE) AS period_start FROM po) GROUP BY period_start"""


def _period(unit: str) -> str:
    inner = _PERIOD.format(unit)
    return _with(
        f"SELECT {_day('period_start')} AS period_start, * EXCLUDE (period_start) FROM ({inner})", "po"
    )


def _growth(group: str, source: str, *layers: str, periods: int = 1, unit: str = "month") -> str:
    same = f"AND e.{group} IS NOT DISTINCT FROM t.{group}" if group else ""
    shown = f"{group}, " if group else ""
    return _with(
        f"""SELECT {shown}{_day('period_start')} AS period_start, revenue, before AS previous_revenue,
                   (revenue - before) / nullif(before, 0) AS growth
            FROM (SELECT t.*, e.revenue AS before FROM ({source}) t LEFT JOIN ({source}) e
                    ON e.period_start = CAST(t.period_start - INTERVAL {periods} {unit} AS DATE) {same})""",
        *layers,
    )


def _share(attribute: str) -> str:
    return _with(
        f"""SELECT {attribute}, revenue, revenue / (SELECT {_money('sub_total')} FROM fs) AS revenue_share
            FROM (SELECT {attribute}, {_money('sub_total')} AS revenue
                  FROM fs JOIN dp ON product_id = product_key GROUP BY {attribute})""",
        "fs", "dp",
    )


def _top_products(order: str, limit: int) -> str:
    return _with(
        f"""SELECT product_key, total_sales_amt, total_quantity_sold, product_name, category, brand_name
            FROM (SELECT product_key, {_money('sub_total')} AS total_sales_amt,
                         {_count('quantity')} AS total_quantity_sold FROM fs GROUP BY product_key)
            JOIN dp ON product_id = product_key ORDER BY {order} DESC, product_key LIMIT {limit}""",
        "fs", "dp",
    )


_CLV = f"""
    SELECT customer_key, CAST(sum(revenue) AS DOUBLE) AS lifetime_value, count(*) AS total_orders,
           max(date_key) AS last_date_key FROM po GROUP BY customer_key"""


def _conversion(*keys: str) -> str:
    flags = "CASE WHEN num_add_to_cart > 0 THEN 1 ELSE 0 END AS reached_cart, " \
            "CASE WHEN has_checkout_view > 0 THEN 1 ELSE 0 END AS reached_checkout"
    return _with(
        f"""SELECT {', '.join(keys)}, count(*) AS sessions, avg(CAST(label AS INTEGER)) AS conversion_rate,
                   avg(duration_seconds) AS avg_duration
            FROM (SELECT *, {flags} FROM sf) GROUP BY {', '.join(keys)}""",
        "sf",
    )


def _by_tier(inner: str, flag: str, counted: str, rate: str, *layers: str) -> str:
    return _with(
        f"""SELECT tier, count(*) AS customers, count(*) FILTER ({flag}) AS {counted},
                   {_div(f'count(*) FILTER ({flag})', 'count(*)')} AS {rate}
            FROM ({inner}) JOIN sc ON customer_id = customer_key GROUP BY tier""",
        *layers, "sc",
    )


def _row_check(table: str, column: str, rule: str, condition: str, name: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, "
        f"count(*) AS failures FROM {table} WHERE {condition}"
    )


def _unique_check(table: str, column: str, name: str) -> str:
    return (
        f"SELECT '{name}', '{column}', 'unique', count(*) FROM "
        f"(SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
    )


def _fk_check(table: str, column: str, to: str, to_column: str, name: str) -> str:
    return (
        f"SELECT '{name}', '{column}', 'relationships', count(*) FROM {table} "
        f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {to_column} FROM {to})"
    )


def _null(table: str, column: str, name: str) -> str:
    return _row_check(table, column, "not_null", f"{column} IS NULL", name)


def _dq_oltp() -> str:
    kinds = "(SELECT DISTINCT p_type AS category_id FROM part)"
    brands = "(SELECT DISTINCT p_brand AS brand_id FROM part)"
    parts = "(SELECT p_partkey AS product_id, p_type AS category_id, p_brand AS brand_id FROM part)"
    pays = "(SELECT DISTINCT CAST(o_orderpriority[1] AS BIGINT) AS payment_method_id FROM orders)"
    soi = "(SELECT si.* FROM si JOIN so USING (order_id))"
    checks = [
        _null("so", "order_id", "orders"), _null("so", "customer_id", "orders"),
        _null("so", "total_amount", "orders"),
        _row_check("so", "total_amount", "accepted_range", "total_amount < 0", "orders"),
        _null("so", "payment_method_id", "orders"),
        _unique_check("so", "order_id", "orders"),
        _fk_check("so", "customer_id", "sc", "customer_id", "orders"),
        _fk_check("so", "payment_method_id", pays, "payment_method_id", "orders"),
        *[_null(soi, c, "orders_items") for c in ("order_item_id", "order_id", "product_id")],
        _unique_check(soi, "order_item_id", "orders_items"),
        _fk_check(soi, "order_id", "so", "order_id", "orders_items"),
        _fk_check(soi, "product_id", parts, "product_id", "orders_items"),
        _null("sc", "customer_id", "customers"), _unique_check("sc", "customer_id", "customers"),
        _null(parts, "product_id", "products"), _unique_check(parts, "product_id", "products"),
        _null(parts, "category_id", "products"),
        _fk_check(parts, "category_id", kinds, "category_id", "products"),
        _fk_check(parts, "brand_id", brands, "brand_id", "products"),
        _null(kinds, "category_id", "categories"), _unique_check(kinds, "category_id", "categories"),
        _null(brands, "brand_id", "brands"), _unique_check(brands, "brand_id", "brands"),
        _null(pays, "payment_method_id", "payment_method"),
        _unique_check(pays, "payment_method_id", "payment_method"),
    ]
    return _with(" UNION ALL ".join(checks), "so", "si", "sc")


def _dq_activity() -> str:
    sessions, actions = "user_sessions", "session_actions"
    rows = "(SELECT *, md5(session_id || idx) AS action_id, started + to_seconds(time_offset) AS action_timestamp, " \
           "kind AS action_type, year(ingest_date) AS year, month(ingest_date) AS month, day(ingest_date) AS day FROM act)"
    kinds = "'view', 'add_to_cart', 'purchase', 'search', 'wishlist', 'review', 'remove_from_cart'"
    checks = [
        *[_null("us", c, sessions) for c in
          ("session_id", "timestamp", "duration_seconds", "page_views", "actions_count")],
        _row_check("us", "duration_seconds", "accepted_range", "duration_seconds NOT BETWEEN 0 AND 86400", sessions),
        _row_check("us", "page_views", "accepted_range", "page_views < 0", sessions),
        _row_check("us", "actions_count", "accepted_range", "actions_count < 0", sessions),
        _row_check("us", "device_type", "accepted_values",
                   "device_type NOT IN ('mobile', 'desktop', 'tablet')", sessions),
        _unique_check("us", "session_id", sessions),
        *[_null(rows, c, actions) for c in
          ("action_id", "session_id", "action_timestamp", "action_type", "year", "month", "day")],
        _row_check(rows, "action_type", "accepted_values", f"action_type NOT IN ({kinds})", actions),
        *[_row_check(rows, c, "accepted_values", f"{c} NOT IN (0, 1)", actions)
          for c in ("is_view", "is_add_to_cart", "is_purchase")],
        _row_check(rows, "month", "accepted_range", "month NOT BETWEEN 1 AND 12", actions),
        _row_check(rows, "day", "accepted_range", "day NOT BETWEEN 1 AND 31", actions),
        _unique_check(rows, "action_id", actions),
        _fk_check(rows, "session_id", "us", "session_id", actions),
    ]
    return _with(" UNION ALL ".join(checks), "us")


def _dq_sales(last_day: str = "2001-08-01") -> str:
    name = "fact_sales"
    checks = [
        _null("fs", "order_id", name),
        _row_check("fs", "quantity", "accepted_range", "quantity < 0", name),
        _row_check("fs", "sub_total", "accepted_range", "sub_total < 0", name),
        _row_check("so", "order_date", "not_after", f"order_date > DATE '{last_day}'", "orders"),
        _fk_check("fs", "product_key", "part", "p_partkey", name),
        _fk_check("fs", "customer_key", "customer", "c_custkey", name),
        f"SELECT '{name}', 'date_key', 'relationships', count(*) FROM fs "
        "WHERE order_date NOT BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'",
    ]
    return _with(" UNION ALL ".join(checks), "fs")


_SNAPSHOT_ROWS = """
    first AS (SELECT * EXCLUDE (address) FROM sc WHERE tier <> 'FURNITURE'),
    second AS (SELECT customer_id, first_name, last_name, coalesce(email, 'asked@example.com') AS email,
                      phone_number, gender, CASE tier WHEN 'BUILDING' THEN 'GOLD' ELSE tier END AS tier
               FROM sc WHERE tier <> 'MACHINERY'),
    differs AS (SELECT customer_id FROM first JOIN second USING (customer_id)
                WHERE first.email IS DISTINCT FROM second.email OR first.tier <> second.tier),
    state AS (SELECT first.*, TIMESTAMP '2024-01-01' AS valid_from,
                     CASE WHEN customer_id IN (SELECT customer_id FROM differs)
                          THEN TIMESTAMP '2024-02-01' END AS valid_to FROM first
              UNION ALL
              SELECT second.*, TIMESTAMP '2024-02-01', NULL FROM second
              WHERE customer_id IN (SELECT customer_id FROM differs)
                 OR customer_id NOT IN (SELECT customer_id FROM first))"""

_ORDER_COLUMNS = f"order_id, customer_id, {_day('order_date')} AS order_date, total_amount, payment_method_id"
_SILVER_ORDERS = _with(
    f"""SELECT {_ORDER_COLUMNS}, {_stamp('created_at')} AS created_at, {_stamp('created_at')} AS updated_at,
               year, month, day FROM so""",
    "so",
)
_FACT_ORDER_ITEMS = _with("SELECT * EXCLUDE (order_id, order_date) FROM fs", "fs")
_SESSION_FEATURES = _with("SELECT * FROM sf", "sf")
_SESSION_ACTIONS = _with(
    f"""SELECT md5(session_id || idx) AS action_id, session_id,
               {_stamp('started + to_seconds(time_offset)')} AS action_timestamp, kind AS action_type,
               product_id, search_term, order_id, revenue, price AS product_price,
               category AS product_category, is_view, is_add_to_cart, is_purchase, is_search, is_wishlist,
               is_review, is_remove_from_cart, is_checkout_view, {_ymd('ingest_date')} FROM act""",
    "act",
)
_FEATURES = _with(f"SELECT * REPLACE ({_day('prediction_date')} AS prediction_date) FROM ft", "ft")
_PRODUCT_COUNTS = f"""
    SELECT product_key, {_count('is_view')} AS views, {_count('is_add_to_cart')} AS add_to_carts,
           {_count('is_purchase')} AS purchases,
           {_money('CASE WHEN is_purchase = 1 THEN revenue ELSE 0 END')} AS revenue
    FROM fb WHERE product_key IS NOT NULL GROUP BY product_key"""
_PRODUCT_KPIS = f"""
    SELECT product_key, views, add_to_carts, purchases, {_pct('add_to_carts', 'views')} AS add_to_cart_rate,
           {_pct('purchases', 'views')} AS conversion_rate FROM ({_PRODUCT_COUNTS})"""
_CAMPAIGN = f"""
    SELECT customer_id, {_day('prediction_date')} AS campaign_date, purchase_probability, customer_segment,
           campaign_action, first_name, last_name, email, phone, year, month, day,
           {_stamp('prediction_timestamp')} AS predicted_at, '2024-01-16 00:00:00' AS created_at FROM cp"""
_SOURCES = f"""
    SELECT traffic_source, {_money('total_revenue')} AS revenue, {_count('total_sessions')} AS sessions,
           {_count('converted_sessions')} AS converted_sessions,
           {_pct('sum(converted_sessions)', 'sum(total_sessions)')} AS conversion_rate
    FROM fd GROUP BY traffic_source"""


def statements() -> dict[str, str]:
    """Query name to SQL, nullable whole numbers shown as text."""
    shown = _statements()
    for name, columns in NULLABLE_NUMBERS.items():
        if name not in shown:
            continue
        text = ", ".join(f"CAST({column} AS VARCHAR) AS {column}" for column in columns)
        shown[name] = f"SELECT * REPLACE ({text}) FROM ({shown[name]})"
    return shown


def _statements() -> dict[str, str]:
    key = "year(d) * 10000 + month(d) * 100 + day(d)"
    weekend = "dayofweek(d) IN (0, 6)"
    age = "date_diff('day', order_date, DATE '2001-08-01')"
    since = "CAST(order_date AS DATE)"
    tier = "CASE WHEN lifetime_value >= 3000000 THEN 'VIP' WHEN lifetime_value >= 2000000 THEN 'High Value' " \
           "WHEN lifetime_value >= 1000000 THEN 'Medium Value' ELSE 'Low Value' END"
    return {
        "silver_orders": _SILVER_ORDERS,
        "bronze_csv_orders": _SILVER_ORDERS,
        "silver_orders_items": _with(
            "SELECT si.*, year, month, day FROM si JOIN so USING (order_id)", "si", "so"
        ),
        "silver_products": """
            SELECT p_partkey AS product_id, p_name AS product_name, p_type AS product_description,
                   p_retailprice AS price, CAST('0x' || substr(md5(p_type), 1, 15) AS BIGINT) AS category_id,
                   p_brand AS brand_id, '2020-01-01 00:00:00' AS created_at, '2020-01-01 00:00:00' AS updated_at
            FROM part""",
        "silver_customers": _with(
            "SELECT *, '2020-01-01 00:00:00' AS created_at, '2020-01-01 00:00:00' AS updated_at FROM sc", "sc"
        ),
        "silver_brands": """
            SELECT DISTINCT p_brand AS brand_id, 'Maker ' || split_part(p_brand, '#', 2) AS brand_name,
                   'unknown' AS brand_origin FROM part""",
        "silver_categories": """
            SELECT DISTINCT CAST('0x' || substr(md5(p_type), 1, 15) AS BIGINT) AS category_id,
                   p_type AS category_name, 'All ' || p_type AS category_description FROM part""",
        "silver_payment_method": """
            SELECT DISTINCT CAST(o_orderpriority[1] AS BIGINT) AS payment_method_id,
                   substr(o_orderpriority, 3) AS display_name, 'house' AS provider, 'standard' AS type
            FROM orders""",
        "dim_payment_method": """
            SELECT DISTINCT CAST(o_orderpriority[1] AS BIGINT) AS payment_method_id,
                   substr(o_orderpriority, 3) AS display_name, 'house' AS provider, 'standard' AS type
            FROM orders""",
        "dim_products": _with("SELECT * FROM dp", "dp"),
        "dim_customers": _with(
            "SELECT customer_id, first_name, last_name, gender, address, tier FROM sc", "sc"
        ),
        "dim_date": _with(
            f"""SELECT {key} AS date_key, {_day('d')} AS calendar_date, year(d) AS year, month(d) AS month,
                       month(d) || '-' || year(d) AS month_year, quarter(d) AS quarter,
                       'Q' || quarter(d) AS quarter_name, 'Q' || quarter(d) || '-' || year(d) AS quarter_year,
                       monthname(d) AS month_name, dayname(d) AS day_name,
                       CASE WHEN {weekend} THEN 1 ELSE 0 END AS is_weekend,
                       CASE WHEN {weekend} THEN 0 ELSE 1 END AS is_weekday
                FROM ({_ORDER_DAYS})""",
            "so",
        ),
        "dim_date_extended": _with(
            f"""SELECT {key} AS date_key, day(d) AS day, isodow(d) AS day_of_week,
                       d NOT IN (SELECT order_date FROM so) AS is_holiday,
                       year(d - INTERVAL 3 MONTH) AS fiscal_year, quarter(d - INTERVAL 3 MONTH) AS fiscal_quarter
                FROM ({_ORDER_DAYS})""",
            "so",
        ),
        "fact_orders": _with("SELECT * EXCLUDE (order_date) FROM fo", "fo"),
        "fact_order_items": _FACT_ORDER_ITEMS,
        "fact_order_items_from_silver": _FACT_ORDER_ITEMS,
        "fact_sale_product_daily": _with(
            f"""SELECT date_key || '_' || product_key AS product_date_key, date_key, product_key,
                       {_money('sub_total')} AS total_sales_amt, {_count('quantity')} AS total_quantity_sold,
                       {_money('discount_amt')} AS total_discount_amount,
                       count(DISTINCT order_id) AS total_order_count,
                       {_div(_money('sub_total'), 'sum(quantity)')} AS avg_unit_price
                FROM fs GROUP BY date_key, product_key""",
            "fs",
        ),
        "daily_sales": _with(
            f"""SELECT {_day('order_date')} AS calendar_date, dayname(order_date) AS day_name,
                       {_money('sub_total')} AS daily_revenue, count(DISTINCT order_id) AS order_count,
                       {_div(_money('sub_total'), 'count(*)')} AS avg_line_item_value
                FROM fs GROUP BY order_date""",
            "fs",
        ),
        "tier_value": _with(
            f"""SELECT tier AS customer_tier, count(DISTINCT customer_id) AS customer_count,
                       {_money('sub_total')} AS total_revenue,
                       {_div(_money('sub_total'), 'count(DISTINCT customer_id)')} AS revenue_per_customer,
                       {_div('count(DISTINCT order_id)', 'count(DISTINCT customer_id)')} AS avg_orders_per_customer
                FROM fs JOIN sc ON customer_id = customer_key GROUP BY tier""",
            "fs", "sc",
        ),
        "weekday_sales": _with(
            f"""SELECT isodow(order_date) AS day_of_week, dayname(order_date) AS day_name,
                       CASE WHEN isodow(order_date) > 5 THEN 1 ELSE 0 END AS is_weekend,
                       count(DISTINCT order_id) AS order_count, {_money('sub_total')} AS total_revenue,
                       {_div(_money('sub_total'), 'count(*)')} AS avg_transaction_value
                FROM fs GROUP BY 1, 2, 3""",
            "fs",
        ),
        "revenue_by_day": _period("day"),
        "revenue_by_week": _period("week"),
        "revenue_by_month": _period("month"),
        "period_growth": _growth("", _PERIOD.format("month"), "po"),
        "growth_week_over_week": _growth("", _PERIOD.format("week"), "po", unit="week"),
        "growth_year_over_year": _growth("", _PERIOD.format("month"), "po", periods=12),
        "category_growth": _growth(
            "category",
            f"""SELECT category, CAST(date_trunc('month', order_date) AS DATE) AS period_start,
                       {_money('sub_total')} AS revenue
                FROM fs JOIN dp ON product_id = product_key GROUP BY 1, 2""",
            "fs", "dp",
        ),
        "order_profile": _with(
            f"""SELECT count(*) AS order_count, CAST(sum(discount) AS DOUBLE) AS total_discount,
                       {_div('sum(lines)', 'count(*)')} AS items_per_order,
                       {_div('sum(units)', 'count(*)')} AS units_per_order,
                       {_div('CAST(sum(prices) AS DOUBLE)', 'sum(lines)')} AS avg_unit_price FROM po""",
            "po",
        ),
        "best_sellers": _top_products("total_sales_amt", 20),
        "best_sellers_by_quantity": _top_products("total_quantity_sold", 10),
        "brand_share": _share("brand_name"),
        "category_share": _share("category"),
        "discount_impact": _with(
            f"""SELECT CAST(round(discount_percent * 100) AS INTEGER) AS discount_pct, count(*) AS line_count,
                       {_count('quantity')} AS units, {_money('sub_total')} AS gross_revenue,
                       {_money('discount_amt')} AS total_discount, {_div('sum(quantity)', 'count(*)')} AS units_per_line
                FROM fs GROUP BY 1""",
            "fs",
        ),
        "clv": _with(_CLV, "po"),
        "top_customers": _with(f"{_CLV} ORDER BY lifetime_value DESC, customer_key LIMIT 100", "po"),
        "repeat_rate": _by_tier(
            "SELECT customer_key, count(*) AS n FROM fo GROUP BY 1", "n > 1", "repeat_customers",
            "repeat_purchase_rate", "fo",
        ),
        "retention": _with(
            f"""SELECT {_day('b.p + INTERVAL 1 MONTH')} AS period_start, count(*) AS previous_customers,
                       count(a.p) AS retained_customers, {_div('count(a.p)', 'count(*)')} AS retention_rate
                FROM (SELECT DISTINCT customer_key, date_trunc('month', order_date) AS p FROM fo) b
                LEFT JOIN (SELECT DISTINCT customer_key, date_trunc('month', order_date) AS p FROM fo) a
                  ON a.customer_key = b.customer_key AND a.p = b.p + INTERVAL 1 MONTH
                WHERE b.p + INTERVAL 1 MONTH <= (SELECT max(date_trunc('month', order_date)) FROM fo)
                GROUP BY b.p""",
            "fo",
        ),
        "churn_by_tier": _by_tier(
            "SELECT customer_key, max(order_date) AS last FROM fo GROUP BY 1",
            "last < DATE '2001-08-01' - 90", "churned_customers", "churn_rate", "fo",
        ),
        "bronze_json_sessions": _with(
            f"SELECT * REPLACE ({_stamp('timestamp')} AS timestamp) FROM us", "us"
        ),
        "user_sessions": _with(f"SELECT * REPLACE ({_stamp('timestamp')} AS timestamp) FROM us", "us"),
        "session_actions": _SESSION_ACTIONS,
        "stream_ingest_actions": _SESSION_ACTIONS,
        "sessions_daily": _with(f"SELECT * REPLACE ({_day('session_date')} AS session_date) FROM sd", "sd"),
        "actions_daily": _with(f"SELECT * REPLACE ({_day('action_date')} AS action_date) FROM ad", "ad"),
        "user_daily_metric": _with(f"SELECT * REPLACE ({_day('activity_date')} AS activity_date) FROM um", "um"),
        "user_behavior_3d_features": _FEATURES,
        "session_features": _SESSION_FEATURES,
        "session_features_joined": _SESSION_FEATURES,
        "time_to_first_action": _with(
            """SELECT us.session_id, min(time_offset) AS time_to_first_action
               FROM us LEFT JOIN act USING (session_id) GROUP BY us.session_id""",
            "us",
        ),
        "conversion_by_segment": _conversion("user_segment"),
        "conversion_by_stage": _conversion("reached_cart", "reached_checkout"),
        "conversion_by_device": _conversion("is_mobile"),
        "label_counts": _with("SELECT label, count(*) AS rows FROM sf GROUP BY label", "sf"),
        "feature_profile": _with(
            """SELECT avg(duration_seconds) AS avg_duration, avg(page_views) AS avg_page_views,
                      avg(num_add_to_cart) AS avg_cart_adds, avg(unique_products_viewed) AS avg_products,
                      avg(CAST(label AS INTEGER)) AS purchase_rate,
                      round(avg(action_velocity), 10) AS avg_action_velocity,
                      round(avg(cart_conversion_rate), 10) AS avg_cart_conversion FROM sf""",
            "sf",
        ),
        "session_interactions": _with(
            """SELECT session_id, CASE WHEN hour_of_day < 6 THEN 'night' WHEN hour_of_day < 12 THEN 'morning'
                           WHEN hour_of_day < 18 THEN 'afternoon' ELSE 'evening' END AS time_of_day_bucket,
                      num_add_to_cart * is_mobile AS cart_adds_on_mobile,
                      CAST(duration_seconds AS DOUBLE) * duration_seconds AS duration_squared FROM sf""",
            "sf",
        ),
        "fact_user_behavior": _with(
            f"""SELECT * REPLACE ({_day('action_date')} AS action_date, {_day('ingest_date')} AS ingest_date,
                                  {_stamp('action_timestamp')} AS action_timestamp) FROM fb""",
            "fb",
        ),
        "fact_daily_metrics": _with(f"SELECT * REPLACE ({_day('metric_date')} AS metric_date) FROM fd", "fd"),
        "funnel": _with(
            f"""SELECT {_day('action_date')} AS action_date, total_views, total_add_to_carts, total_purchases,
                       {_pct('total_add_to_carts', 'total_views')} AS view_to_cart_pct,
                       {_pct('total_purchases', 'total_add_to_carts')} AS cart_to_purchase_pct,
                       {_pct('total_purchases', 'total_views')} AS overall_conversion_pct
                FROM (SELECT action_date, {_count('is_view')} AS total_views,
                             {_count('is_add_to_cart')} AS total_add_to_carts,
                             {_count('is_purchase')} AS total_purchases FROM fb GROUP BY action_date)""",
            "fb",
        ),
        "channel_performance": _with(
            f"""SELECT traffic_source, device_type, {_count('active_users')} AS total_users,
                       {_count('total_sessions')} AS sessions, {_count('total_purchases')} AS purchases,
                       {_money('total_revenue')} AS revenue,
                       {_div(_money('conversion_rate_pct'), 'count(conversion_rate_pct)')} AS avg_conversion_rate,
                       {_div(_money('avg_order_value'), 'count(avg_order_value)')} AS avg_order_value,
                       {_div(_money('total_revenue'), 'sum(active_users)')} AS revenue_per_user
                FROM fd GROUP BY 1, 2""",
            "fd",
        ),
        "product_engagement": _with(
            f"""SELECT product_name, category, brand_name, {_count('views')} AS views,
                       {_count('add_to_carts')} AS add_to_carts, {_count('purchases')} AS purchases,
                       {_money('revenue')} AS total_revenue,
                       {_pct('sum(add_to_carts)', 'sum(views)')} AS view_to_cart_rate,
                       {_pct('sum(purchases)', 'sum(add_to_carts)')} AS cart_to_purchase_rate
                FROM ({_PRODUCT_COUNTS}) JOIN dp ON product_id = product_key
                GROUP BY product_name, category, brand_name HAVING sum(views) >= 50
                ORDER BY views DESC, cart_to_purchase_rate, product_name, category, brand_name LIMIT 20""",
            "fb", "dp",
        ),
        "product_kpis": _with(_PRODUCT_KPIS, "fb"),
        "viewed_not_bought": _with(
            f"SELECT * FROM ({_PRODUCT_KPIS}) WHERE views >= 60 AND conversion_rate <= 25", "fb"
        ),
        "conversion_kpis": _with(
            f"""SELECT {_day('metric_date')} AS metric_date,
                       {_pct('sum(total_purchases)', 'sum(total_sessions)')} AS conversion_rate,
                       {_pct('sum(total_add_to_carts)', 'sum(total_views)')} AS view_to_cart_rate,
                       {_pct('sum(total_purchases)', 'sum(total_add_to_carts)')} AS cart_to_purchase_rate,
                       (10000 - {_pct('sum(total_purchases)', 'sum(total_add_to_carts)')} * 100)
                         / CAST(100 AS DOUBLE) AS abandonment_rate,
                       {_div(_money('total_revenue'), 'sum(total_purchases)')} AS avg_order_value,
                       {_div(_money('total_revenue'), 'sum(total_sessions)')} AS revenue_per_session
                FROM fd GROUP BY fd.metric_date""",
            "fd",
        ),
        "engagement_kpis": _with(
            f"""SELECT {_day('CAST(timestamp AS DATE)')} AS session_date,
                       count(DISTINCT user_id) AS daily_active_users, count(*) AS sessions,
                       avg(duration_seconds) AS avg_session_duration, avg(page_views) AS pages_per_session,
                       avg(CASE WHEN actions_count = 1 THEN 1 ELSE 0 END) AS bounce_rate
                FROM us GROUP BY 1""",
            "us",
        ),
        "weekly_active_users": _with(
            f"""SELECT {_day("date_trunc('week', timestamp)")} AS period_start,
                       count(DISTINCT user_id) AS active_users FROM us GROUP BY 1""",
            "us",
        ),
        "source_performance": _with(_SOURCES, "fd"),
        "campaign_performance": _with(
            f"""SELECT utm_campaign, count(DISTINCT session_id) AS sessions,
                       count(DISTINCT CASE WHEN is_purchase = 1 THEN session_id END) AS converted_sessions,
                       {_money('CASE WHEN is_purchase = 1 THEN revenue ELSE 0 END')} AS revenue,
                       {_pct('count(DISTINCT CASE WHEN is_purchase = 1 THEN session_id END)',
                             'count(DISTINCT session_id)')} AS conversion_rate
                FROM fb WHERE utm_campaign IS NOT NULL GROUP BY utm_campaign""",
            "fb",
        ),
        "search_terms": _with(
            """SELECT search_term, count(*) AS searches,
                      count(*) FILTER (results_count = 0) AS searches_without_results
               FROM act WHERE kind = 'search' GROUP BY search_term""",
            "act",
        ),
        "marketing_cost": _with(
            f"""SELECT traffic_source, spend, {_div('spend', 'users')} AS cac,
                       {_div('spend', 'converted_sessions')} AS cpa, {_div('revenue', 'spend')} AS roas
                FROM (SELECT utm_source AS traffic_source, count(DISTINCT user_id) AS users,
                             {_money('CAST(duration_seconds * 3 AS DOUBLE) / CAST(100 AS DOUBLE)')} AS spend
                      FROM us GROUP BY 1) JOIN ({_SOURCES}) USING (traffic_source)""",
            "fd",
        ),
        "campaign": _with(_CAMPAIGN, "cp"),
        "hot_leads": _with(
            f"""SELECT * FROM ({_CAMPAIGN}) WHERE customer_segment = 'Hot Lead'
                ORDER BY purchase_probability DESC, customer_id LIMIT 100""",
            "cp",
        ),
        "campaign_segments": _with(
            "SELECT customer_segment, count(*) AS customers, count(phone) AS with_phone FROM cp GROUP BY 1", "cp"
        ),
        "cart_recovery_campaign": _with(
            f"""SELECT *, CASE recovery_priority WHEN 'Urgent - High Value' THEN 'Personal call and free shipping'
                             WHEN 'High Priority' THEN 'Free shipping' WHEN 'Medium Priority' THEN 'Discount code'
                             ELSE 'Reminder' END AS recommended_incentive
                FROM (SELECT sc.customer_id, add_to_cart_count_3d AS items_in_cart,
                             add_to_cart_count_3d * avg_product_price_3d AS estimated_cart_value,
                             purchase_probability, {_day('pr.prediction_date')} AS campaign_date, email,
                             CASE WHEN purchase_probability >= 0.6
                                       AND add_to_cart_count_3d * avg_product_price_3d >= 3000
                                  THEN 'Urgent - High Value'
                                  WHEN purchase_probability >= 0.6 THEN 'High Priority'
                                  WHEN purchase_probability >= 0.3 THEN 'Medium Priority'
                                  ELSE 'Low Priority' END AS recovery_priority
                      FROM ft JOIN pr USING (user_id, prediction_date) JOIN sc ON sc.customer_id = ft.user_id
                      WHERE email IS NOT NULL AND add_to_cart_count_3d >= 1 AND purchase_count_3d = 0
                        AND pr.prediction_date = DATE '2024-01-15')""",
            "ft", "pr", "sc",
        ),
        "latest_prediction": _with(
            f"""SELECT * EXCLUDE (rn) REPLACE ({_day('prediction_date')} AS prediction_date,
                       {_stamp('prediction_timestamp')} AS prediction_timestamp)
                FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY prediction_timestamp DESC) AS rn
                      FROM pr) WHERE rn = 1""",
            "pr",
        ),
        "recent_predictions": _with(
            f"""SELECT * REPLACE ({_day('prediction_date')} AS prediction_date,
                       {_stamp('prediction_timestamp')} AS prediction_timestamp)
                FROM pr WHERE prediction_date BETWEEN DATE '2024-01-15' - 7 AND DATE '2024-01-15'""",
            "pr",
        ),
        "prediction_summary": _with(
            """SELECT count(*) AS total, count(*) FILTER (will_purchase_tomorrow = 1) AS predicted_buyers,
                      round(avg(purchase_probability), 10) AS avg_probability FROM pr""",
            "pr",
        ),
        "positive_predictions": _with(
            f"""SELECT user_id AS customer_id, {_day('prediction_date')} AS prediction_date, purchase_probability,
                       {_stamp('prediction_timestamp')} AS predicted_at
                FROM pr WHERE will_purchase_tomorrow = 1 AND purchase_probability >= 0.5
                  AND prediction_date = DATE '2024-01-15'""",
            "pr",
        ),
        "unpredicted_customers": _with(
            f"""SELECT user_id, {_day('prediction_date')} AS prediction_date, sessions_3d FROM ft
                WHERE prediction_date = DATE '2024-01-15' AND user_id NOT IN
                      (SELECT user_id FROM pr WHERE prediction_date = DATE '2024-01-16')""",
            "ft", "pr",
        ),
        "intervention_bands": _with(
            """SELECT CASE WHEN purchase_probability > 0.7 THEN 'minimal intervention'
                           WHEN purchase_probability >= 0.3 THEN 'targeted offer' ELSE 'remarketing' END AS band,
                      count(*) AS predictions FROM pr GROUP BY 1""",
            "pr",
        ),
        "dormant_campaign": _with(
            f"""SELECT *, CASE value_tier WHEN 'VIP' THEN 'VIP Re-engagement' WHEN 'High Value' THEN 'High Priority'
                             WHEN 'Medium Value' THEN 'Standard Priority' ELSE 'Low Priority' END AS campaign_priority,
                       CASE value_tier WHEN 'VIP' THEN 'Exclusive gift' WHEN 'High Value' THEN 'Loyalty bonus'
                             WHEN 'Medium Value' THEN 'Discount code' ELSE 'Newsletter' END AS recommended_offer
                FROM (SELECT customer_id, {_day('last')} AS last_order_date,
                             date_diff('day', last, DATE '2001-08-01') AS days_since_last_purchase, total_orders,
                             lifetime_value, lifetime_value / total_orders AS avg_order_value,
                             p AS purchase_probability, email,
                             CASE WHEN last <= DATE '2001-02-01' THEN 'Long Dormant (6+ months)'
                                  WHEN last <= DATE '2001-05-01' THEN 'Medium Dormant (3-6 months)'
                                  ELSE 'Recently Dormant (1-3 months)' END AS dormancy_segment,
                             {tier} AS value_tier, '2001-08-01' AS campaign_date
                      FROM (SELECT customer_key, max(order_date) AS last, count(*) AS total_orders,
                                   CAST(sum(revenue) AS DOUBLE) AS lifetime_value FROM po GROUP BY 1)
                      JOIN pe ON customer_id = customer_key JOIN sc USING (customer_id)
                      WHERE email IS NOT NULL AND p >= 0.6 AND last <= DATE '2001-08-01' - 30)""",
            "po", "pe", "sc",
        ),
        "campaign_scores": _with(
            f"""SELECT pe.customer_id,
                       least(greatest(p * 60 + least(coalesce(s3, 0) / CAST(10 AS DOUBLE), 1) * 25
                             + greatest(1 - CAST(coalesce(days, 90) AS DOUBLE) / 90, 0) * 15, 0), 100)
                         AS campaign_priority_score,
                       least(coalesce(s3, 0) / CAST(10 AS DOUBLE), 1) AS engagement_score,
                       coalesce(ever, 0) + p * 1 * coalesce(spent, 0) AS estimated_clv,
                       'Email' AS primary_contact_channel, coalesce(n30, 0) AS orders_count_30d,
                       coalesce(spent, 0) AS total_spent_30d, days AS days_since_last_purchase
                FROM pe JOIN sc ON sc.customer_id = pe.customer_id
                LEFT JOIN (SELECT customer_key, count(*) FILTER ({age} <= 30) AS n30,
                                  {_money(f'CASE WHEN {age} <= 30 THEN total_amount END')} AS spent,
                                  {_money('total_amount')} AS ever, min({age}) AS days
                           FROM fo WHERE {since} <= DATE '2001-08-01' GROUP BY 1) h ON customer_key = pe.customer_id
                LEFT JOIN (SELECT user_id, max(sessions_3d) AS s3 FROM ft GROUP BY 1) f ON user_id = pe.customer_id
                WHERE email IS NOT NULL AND p >= 0.5""",
            "pe", "sc", "fo", "ft",
        ),
        "merge_orders": _with(
            f"""SELECT order_id, customer_id, {_day('moved')} AS order_date,
                       total_amount + CASE status WHEN 'F' THEN 1 ELSE 0 END AS total_amount, payment_method_id,
                       year(moved) AS year, month(moved) AS month, day(moved) AS day
                FROM (SELECT *, CASE WHEN status = 'F' AND payment_method_id = 1
                                     THEN order_date + INTERVAL 1 MONTH ELSE order_date END AS moved FROM so)""",
            "so",
        ),
        "replace_partition": _with(
            f"""SELECT user_id, {_day('prediction_date')} AS prediction_date, will_purchase_tomorrow,
                       CASE WHEN prediction_date = DATE '2024-01-15' THEN 1 - purchase_probability
                            ELSE purchase_probability END AS purchase_probability FROM pr""",
            "pr",
        ),
        "scd2_customers": _with(
            "SELECT * FROM sc", "sc"
        ).replace("\nSELECT * FROM sc", f""",{_SNAPSHOT_ROWS}
            SELECT * EXCLUDE (valid_from, valid_to),
                   md5(customer_id || '|' || {_stamp('valid_from')}) AS scd_row_id,
                   {_stamp('valid_from')} AS scd_valid_from, {_stamp('valid_to')} AS scd_valid_to,
                   coalesce(strftime(valid_to, '%Y-%m'), 'open') AS closed_month FROM state"""),
        "scd2_dimension": _with(
            "SELECT * FROM sc", "sc"
        ).replace("\nSELECT * FROM sc", f""",{_SNAPSHOT_ROWS}
            SELECT customer_id AS natural_key, * EXCLUDE (customer_id, valid_from, valid_to),
                   {_stamp('valid_from')} AS effective_start_date, {_stamp('valid_to')} AS effective_end_date,
                   valid_to IS NULL AS is_current FROM state"""),
        "extract_month_items": _with(
            """SELECT si.* REPLACE (CAST(quantity AS DOUBLE) AS quantity), 1998 AS year, 12 AS month FROM si
               WHERE order_id IN (SELECT order_id FROM so WHERE year = 1998 AND month = 12)""",
            "so", "si",
        ),
        "dq_oltp": _dq_oltp(),
        "dq_activity": _dq_activity(),
        "dq_sales": _dq_sales(),
        "dq_duplicate_items": _with(
            """SELECT order_item_id, count(*) AS rows FROM si JOIN so USING (order_id)
               GROUP BY order_item_id HAVING count(*) > 1""",
            "si", "so",
        ),
        "dq_equal_rowcount": _with(
            """SELECT left_rows, right_rows FROM (SELECT count(*) AS left_rows FROM us),
                      (SELECT count(*) AS right_rows FROM act) WHERE left_rows <> right_rows""",
            "us",
        ),
        "score_outside_model": _with(
            f"""SELECT user_id, {_day('prediction_date')} AS prediction_date,
                       CAST(share >= 0.25 AS INTEGER) AS will_purchase_tomorrow, share AS purchase_probability
                FROM (SELECT *, CAST(add_to_cart_count_3d AS DOUBLE)
                               / (add_to_cart_count_3d + view_count_3d + 1) AS share FROM ft)""",
            "ft",
        ),
    }
