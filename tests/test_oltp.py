import datetime as dt

from cartwheel.operators import facts, oltp
from cartwheel.schemas import BRONZE_CSV


def bronze(spark, table, *lines):
    return spark.createDataFrame(list(lines), BRONZE_CSV[table])


def sales_month(spark):
    from pyspark.sql import functions as F

    orders = bronze(
        spark, "orders",
        ("1", "7", "2024-02-29", "10.5", "1", "2024-02-29 08:00:00", "2024-03-01 09:00:00"),
        ("2", "8", "2024-03-02", "20", "2", "2024-03-02 08:00:00", None),
        ("x", "9", "not a date", "abc", "2", "bad", None),
    )
    return orders.withColumn("year", F.lit(2024)).withColumn("month", F.substring("order_date", 7, 1).try_cast("int"))


def test_bad_values_become_null(spark, rows):
    out = oltp.orders(sales_month(spark)).where("customer_id = 9")
    assert rows(out) == [(None, 9, None, None, 2, None, None, None, None, None)]


def test_dates_are_parsed_and_split(spark, rows):
    out = oltp.orders(sales_month(spark)).where("order_id = 1")
    stamp = dt.datetime(2024, 2, 29, 8)
    assert rows(out) == [(1, 7, dt.date(2024, 2, 29), 10.5, 1, stamp, stamp, 2024, 2, 29)]


def test_updated_at_repeats_created_at(spark, rows):
    out = oltp.orders(sales_month(spark)).where("order_id is not null")
    assert all(created == updated for created, updated in rows(out, "created_at", "updated_at"))


def test_month_slice(spark, rows):
    assert rows(oltp.orders(sales_month(spark), 2024, 3), "order_id") == [(2,)]


def test_text_is_trimmed_but_not_the_address(spark, rows):
    customers = bronze(
        spark, "customers",
        ("1", "  Ann ", "Lee", " a@b.c", " 1 ", "F", " Gold ", "  1 Road ", "2024-01-01 00:00:00", None),
        ("n/a", None, "Lee", None, None, None, None, None, "never", None),
    )
    out = oltp.customers(customers)
    assert rows(out.where("customer_id = 1"), "first_name", "tier", "email", "address") == [
        ("Ann", "Gold", "a@b.c", "  1 Road ")
    ]
    assert rows(out.where("customer_id is null"), "first_name", "created_at") == [(None, None)]


def test_small_tables(spark, rows):
    assert rows(oltp.brands(bronze(spark, "brands", (" b1 ", " Acme ", " VN ")))) == [("b1", "Acme", "VN")]
    assert rows(oltp.categories(bronze(spark, "category", ("3", " Shoes ", " All ")))) == [(3, "Shoes", "All")]
    assert rows(oltp.payment_method(bronze(spark, "payment_method", ("1", " Card ", "V ", " c")))) == [
        (1, "Card", "V", "c")
    ]
    products = oltp.products(
        bronze(spark, "products", ("5", " P ", None, "9.5", "3", " b1 ", "2024-01-01 00:00:00", "bad"))
    )
    assert rows(products, "product_id", "product_name", "price", "category_id", "brand_id", "updated_at") == [
        (5, "P", 9.5, 3, "b1", None)
    ]


def items(spark):
    return bronze(
        spark, "order_items",
        ("11", "1", "5", "2", "10.0", "0.25"),
        ("12", "1", "6", "1", "3.0", "0"),
        ("21", "2", "5", "1", "10.0", "0.1"),
        ("99", "404", "5", "1", "10.0", "0"),
    )


def test_items_inherit_the_order_date_and_orphans_drop(spark, rows):
    out = oltp.orders_items(items(spark), oltp.orders(sales_month(spark)))
    assert rows(out, "order_item_id", "year", "month", "day") == [
        (11, 2024, 2, 29), (12, 2024, 2, 29), (21, 2024, 3, 2)
    ]


def test_line_measures(spark, rows):
    orders = oltp.orders(sales_month(spark))
    fact = facts.fact_order_items(oltp.orders_items(items(spark), orders), orders)
    assert "order_id" not in fact.columns
    assert rows(fact, "order_item_id", "date_key", "customer_key", "sub_total", "discount_amt", "total_amount") == [
        (11, 20240229, 7, 20.0, 5.0, 15.0),
        (12, 20240229, 7, 3.0, 0.0, 3.0),
        (21, 20240302, 8, 10.0, 1.0, 9.0),
    ]


def test_one_join_gives_the_same_fact(spark, rows):
    orders = oltp.orders(sales_month(spark))
    once = facts.sales_lines(oltp.items_with_order(items(spark), orders))
    twice = facts.fact_sales(oltp.orders_items(items(spark), orders), orders)
    assert rows(once, *sorted(once.columns)) == rows(twice, *sorted(once.columns))


def test_month_by_month_equals_full_build(spark, rows):
    from pyspark.sql import functions as F

    orders = oltp.orders(sales_month(spark))
    dated = items(spark).withColumns({"year": F.lit(2024), "month": F.when(F.col("order_id") == "1", 2).otherwise(3)})
    full = oltp.orders_items(items(spark), orders)
    parts = oltp.orders_items(dated, orders, 2024, 2).unionByName(oltp.orders_items(dated, orders, 2024, 3))
    assert rows(parts) == rows(full)


def test_product_day_totals(spark, rows):
    orders = oltp.orders(sales_month(spark))
    daily = facts.fact_sale_product_daily(facts.sales_lines(oltp.items_with_order(items(spark), orders)))
    assert rows(daily, "product_date_key", "total_sales_amt", "total_quantity_sold", "total_discount_amount",
                "total_order_count", "avg_unit_price") == [
        ("20240229_5", 20.0, 2, 5.0, 1, 10.0),
        ("20240229_6", 3.0, 1, 0.0, 1, 3.0),
        ("20240302_5", 10.0, 1, 1.0, 1, 10.0),
    ]


def test_zero_quantity_has_no_mean_price(spark, rows):
    sales = spark.createDataFrame(
        [(20240101, 1, 0.0, 0, 0.0)], "date_key int, product_key bigint, sub_total double, quantity int, discount_amt double"
    )
    assert rows(facts.fact_sale_product_daily(sales), "avg_unit_price") == [(None,)]
