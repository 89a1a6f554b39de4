import datetime as dt

from cartwheel.operators import dimensions


def test_spine_covers_eleven_years(spark):
    assert dimensions.dim_date(spark).count() == 4018


def test_date_attributes(spark, rows):
    dates = dimensions.dim_date(spark, dt.date(2024, 2, 29), dt.date(2024, 3, 3))
    assert rows(dates.where("date_key = 20240229")) == [
        (20240229, dt.date(2024, 2, 29), 2024, 2, "2-2024", 1, "Q1", "Q1-2024", "February", "Thursday", 0, 1)
    ]
    assert rows(dates, "day_name", "is_weekend", "is_weekday") == [
        ("Friday", 0, 1), ("Saturday", 1, 0), ("Sunday", 1, 0), ("Thursday", 0, 1)
    ]


def test_extended_dates(spark, rows):
    dates = dimensions.dim_date(spark, dt.date(2024, 3, 31), dt.date(2024, 4, 1))
    holidays = spark.createDataFrame([(dt.date(2024, 4, 1),)], "holiday_date date")
    out = dimensions.dim_date_extended(dates, holidays, fiscal_start_month=4)
    assert rows(out, "day", "day_of_week", "is_holiday", "fiscal_year", "fiscal_quarter") == [
        (1, 1, True, 2024, 1), (31, 7, False, 2023, 4)
    ]
    assert rows(dimensions.dim_date_extended(dates), "is_holiday") == [(False,), (False,)]


def test_products_keep_unknown_brand(spark, rows):
    products = spark.createDataFrame(
        [(1, "a", "d", 1.0, 10, "b1"), (2, "b", "d", 2.0, 99, "none"), (3, "c", "d", 3.0, None, None)],
        "product_id bigint, product_name string, product_description string, price double,"
        " category_id bigint, brand_id string",
    )
    categories = spark.createDataFrame([(10, "Shoes", "x")], "category_id bigint, category_name string, category_description string")
    brands = spark.createDataFrame([("b1", "Acme", "VN")], "brand_id string, brand_name string, brand_origin string")
    out = dimensions.dim_products(products, categories, brands)
    assert rows(out, "product_id", "category", "brand_name") == [
        (1, "Shoes", "Acme"), (2, None, None), (3, None, None)
    ]


def test_customer_dimension_has_no_contact_data(spark):
    customers = spark.createDataFrame(
        [(1, "a", "b", "e", "p", "F", "Gold", "addr")],
        "customer_id bigint, first_name string, last_name string, email string, phone_number string,"
        " gender string, tier string, address string",
    )
    assert set(dimensions.dim_customers(customers).columns).isdisjoint({"email", "phone_number"})
