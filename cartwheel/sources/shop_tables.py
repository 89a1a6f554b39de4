"""Bronze views of the shop over generic order, customer, part and event tables.

Every view is a projection of one table (customers also look up their nation),
so none of them gathers a group into one row.  Only the rows of a large event
table are shuffled, before they become records.  FIXTURES.md
lists the column rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.schemas import ACTION
from cartwheel.session import spread

#: An event is some 60 bytes, the record made of it a kilobyte and more.
EVENTS_PER_TASK = 25_000


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _cents(value: Column) -> Column:
    return F.floor(value * 100 + 0.5).cast("double") / 100


def _category_id(name: Column) -> Column:
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    src = _read(spark, folder, "orders")
    day = F.to_date("o_orderdate")
    return src.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        day.alias("order_date"),
        F.col("o_totalprice").alias("total_amount"),
        F.substring("o_orderpriority", 1, 1).alias("payment_method_id"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    src = _read(spark, folder, "lineitem")
    return src.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        _cents(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_discount").alias("discount"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    src = _read(spark, folder, "part")
    return src.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_description"),
        F.col("p_retailprice").alias("price"),
        _category_id(F.col("p_type")).alias("category_id"),
        F.col("p_brand").alias("brand_id"),
        F.lit("2020-01-01 00:00:00").alias("created_at"),
        F.lit("2020-01-01 00:00:00").alias("updated_at"),
    )


def category(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("p_type")
    return (
        _read(spark, folder, "part")
        .select(kind)
        .distinct()
        .select(
            _category_id(kind).alias("category_id"),
            F.concat(F.lit(" "), kind, F.lit(" ")).alias("category_display_name"),
            F.concat(F.lit("All "), kind).alias("category_description"),
        )
    )


def brands(spark: SparkSession, folder: str) -> DataFrame:
    brand = F.col("p_brand")
    return (
        _read(spark, folder, "part")
        .select(brand)
        .distinct()
        .select(
            brand.alias("brand_id"),
            F.concat(F.lit("  Maker "), F.substring_index(brand, "#", -1)).alias("brand_name"),
            F.lit("unknown").alias("brand_origin"),
        )
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = _read(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("address")
    )
    name, key = F.col("c_name"), F.col("c_custkey")
    return (
        _read(spark, folder, "customer")
        .join(nation, "c_nationkey", "left")
        .select(
            key.alias("customer_id"),
            F.substring_index(name, "#", 1).alias("first_name"),
            F.substring_index(name, "#", -1).alias("last_name"),
            F.when(key % 7 != 0, F.concat(F.lower(name), F.lit("@example.com"))).alias("email"),
            F.concat(F.lit(" +"), (key + 1000000).cast("string")).alias("phone_number"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
            F.col("c_mktsegment").alias("tier"),
            "address",
            F.lit("2020-01-01 00:00:00").alias("created_at"),
            F.lit("2020-01-01 00:00:00").alias("updated_at"),
        )
    )


def payment_method(spark: SparkSession, folder: str) -> DataFrame:
    label = F.col("o_orderpriority")
    return (
        _read(spark, folder, "orders")
        .select(label)
        .distinct()
        .select(
            F.substring(label, 1, 1).alias("payment_method_id"),
            F.substring_index(label, "-", -1).alias("display_name"),
            F.lit("house ").alias("provider"),
            F.lit("standard").alias("type"),
        )
    )


# The browsing steps that lead up to one event, as
# (event type, action type, page, remainder rule on k or None).
STEPS = (
    ("purchase", "view", "/product", None),
    ("purchase", "add_to_cart", "/product", None),
    ("purchase", "view", "/checkout", None),
    ("purchase", "purchase", "/checkout", None),
    ("click", "view", "/product", None),
    ("click", "add_to_cart", "/product", None),
    ("click", "remove_from_cart", "/cart", 4),
    ("view", "view", "/product", None),
    ("view", "view", "/checkout", 10),
    ("signup", "view", "/product", None),
    ("signup", "wishlist", "/product", None),
    ("signup", "review", "/product", 5),
    ("error", "search", "/search", 7),
)


def _steps() -> str:
    """The steps of the row's event type, from a constant map."""
    by_type: dict[str, list[str]] = {}
    for event_type, kind, page, rule in STEPS:
        remainder = "int(NULL)" if rule is None else str(rule)
        by_type.setdefault(event_type, []).append(
            f"named_struct('kind', '{kind}', 'page', '{page}', 'rule', {remainder})"
        )
    entries = ", ".join(f"'{name}', array({', '.join(steps)})" for name, steps in by_type.items())
    return f"try_element_at(map({entries}), event_type)"


# An action's fields by step ``s`` at position ``i``; the others stay NULL.
AT_PRODUCT = "s.kind <> 'search' AND NOT (s.kind = 'view' AND s.page = '/checkout')"
ACTION_FIELDS = {
    "type": "s.kind",
    "page": "s.page",
    "time_offset": "(k + 1) * 10 * i",
    "product_id": f"CASE WHEN {AT_PRODUCT} THEN k END",
    "price": f"CASE WHEN {AT_PRODUCT} THEN (k + 9000) / 10D END",
    "category": f"CASE WHEN s.kind = 'view' AND {AT_PRODUCT} THEN concat('category-', k % 8) END",
    "quantity": "CASE WHEN s.kind IN ('add_to_cart', 'purchase') THEN k % 3 + 1 END",
    "search_term": "CASE WHEN s.kind = 'search' THEN concat('term-', k % 25) END",
    "results_count": "CASE WHEN s.kind = 'search' THEN k % 3 END",
    "rating": "CASE WHEN s.kind = 'review' THEN k % 5 + 1 END",
    "order_id": "CASE WHEN s.kind = 'purchase' THEN concat('ord-', event_id) END",
    "total_amount": "CASE WHEN s.kind = 'purchase' THEN value END",
}


def _actions() -> str:
    """At most four actions per event.  Steps whose remainder rule does not
    hold are left out, so an array can be empty; a search is left out where
    its rule does hold."""
    kept = f"filter({_steps()}, s -> s.rule IS NULL OR (k % s.rule = 0) <> (s.kind = 'search'))"
    fields = ", ".join(
        f"'{f.name}', CAST({ACTION_FIELDS.get(f.name, 'NULL')} AS {f.dataType.simpleString()})"
        for f in ACTION.fields
    )
    return f"transform({kept}, (s, i) -> named_struct({fields}))"


def _choice(selector: str, *choices: str | None) -> str:
    """The choice whose position equals ``selector``."""
    cases = " ".join(f"WHEN {at} THEN '{text}'" for at, text in enumerate(choices) if text is not None)
    return f"CASE {selector} {cases} END"


def activity_logs(spark: SparkSession, folder: str) -> DataFrame:
    """One nested session record per event."""
    base = (
        spread(_read(spark, folder, "events"), EVENTS_PER_TASK, "event_id", "ts", "user_id")
        .selectExpr("*", "CAST(get_json_object(props, '$.k') AS int) AS k")
        # Exploding a one-element array makes the actions a plain column, so
        # filters on them do not build them once more.
        .selectExpr("*", f"explode(array({_actions()})) AS actions")
    )
    duration = "CASE WHEN size(actions) = 0 THEN 0 ELSE (k + 1) * 10 * (size(actions) - 1) + k % 30 END"
    return base.selectExpr(
        "concat('evt-', event_id) AS event_id",
        """date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'") AS timestamp""",
        "CASE WHEN user_id % 10 <> 9 THEN user_id END AS user_id",
        f"{_choice('user_id % 4', 'vip', 'loyal', 'returning', 'new')} AS user_segment",
        "concat('sess-', event_id) AS session_id",
        f"""named_struct('type', {_choice('user_id % 3', 'mobile', 'desktop', 'tablet')},
                         'os', {_choice('user_id % 3', 'android', 'linux', 'ios')},
                         'browser', {_choice('user_id % 2', 'firefox', 'chrome')},
                         'version', '1.0') AS device""",
        """named_struct('city', concat('city-', user_id % 12), 'country', 'VN',
                        'coordinates', named_struct('lat', CAST(user_id % 90 AS double),
                                                    'lon', CAST(user_id % 180 AS double))) AS location""",
        "concat('https://ref', user_id % 5) AS referrer",
        f"{_choice('user_id % 3', 'search_engine', 'social', 'direct')} AS referrer_type",
        f"{_choice('user_id % 6', 'email', 'paid_ads', 'organic', 'social', 'referral', None)} AS source",
        "CASE WHEN k % 3 = 0 THEN concat('camp-', k % 5) END AS campaign",
        "actions",
        f"""named_struct('duration_seconds', {duration},
                         'page_views', size(filter(actions, a -> a.type = 'view')),
                         'actions_count', size(actions),
                         'has_purchase', event_type = 'purchase',
                         'revenue', CASE WHEN event_type = 'purchase' THEN value ELSE 0D END) AS session_metrics""",
        f"""named_struct('ab_test', {_choice('user_id % 2', 'A', 'B')}, 'language', 'vi', 'currency', 'VND',
                         'is_mobile', user_id % 3 = 0) AS properties""",
        "to_date(ts) AS ingest_date",
    )
