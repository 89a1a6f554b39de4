import datetime as dt

from cartwheel.operators import oltp
from cartwheel.sources import bronze, extract
from tests.logs import action, frame, session


def test_csv_round_trip_prunes_by_month(spark, folder, rows):
    lines = [
        ("1", "7", "2024-01-31", "1.5", "1", "2024-01-31 08:00:00", "", 2024, 1),
        ("2", "7", "2024-02-01", "2.5", "1", "2024-02-01 08:00:00", "", 2024, 2),
    ]
    schema = (
        "order_id string, customer_id string, order_date string, total_amount string, payment_method_id string,"
        " created_at string, updated_at string, year int, month int"
    )
    path = f"{folder}/orders"
    bronze.land_csv(spark.createDataFrame(lines, schema), "orders", path, ("year", "month"))
    raw = bronze.read_bronze_csv(spark, "orders", path)
    assert rows(oltp.orders(raw, 2024, 2), "order_id", "total_amount", "order_date") == [(2, 2.5, dt.date(2024, 2, 1))]
    plan = raw.where("year = 2024 and month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: []" in plan and "Filter (" not in plan
    # Landing one month again replaces that month only.
    bronze.land_csv(spark.createDataFrame(lines[:1], schema), "orders", path, ("year", "month"))
    assert bronze.read_bronze_csv(spark, "orders", path).count() == 2


def test_log_round_trip(spark, folder, rows):
    logs = frame(
        spark,
        session("a", 1, actions=[action("purchase", 3, items=[(5, "tea", 2, 1.5)], total_amount=3.0)]),
        session("b", None, "2024-01-02T10:00:00Z", []),
    )
    bronze.land_activity_logs(logs, f"{folder}/logs")
    back = bronze.read_activity_logs(spark, f"{folder}/logs")
    assert rows(back, "session_id", "user_id", "ingest_date") == [
        ("a", 1, dt.date(2024, 1, 1)), ("b", None, dt.date(2024, 1, 2))
    ]
    assert back.where("session_id = 'a'").first().actions[0]["items"][0].quantity == 2


def test_new_folders_become_visible(spark, folder):
    from cartwheel.sinks.tables import write_partitions

    schema = "id bigint, ingest_date date"
    path = f"{folder}/t"
    write_partitions(spark.createDataFrame([(1, dt.date(2024, 1, 1))], schema), path, ["ingest_date"])
    spark.sql(f"CREATE TABLE landed (id bigint, ingest_date date) USING parquet PARTITIONED BY (ingest_date) LOCATION '{path}'")
    bronze.refresh_partitions(spark, "landed")
    write_partitions(spark.createDataFrame([(2, dt.date(2024, 1, 2))], schema), path, ["ingest_date"])
    bronze.refresh_partitions(spark, "landed")
    assert bronze.read_table(spark, "landed").count() == 2
    spark.sql("DROP TABLE landed")


def test_month_bounds():
    assert extract.month_bounds(2024, 12) == (dt.date(2024, 12, 1), dt.date(2025, 1, 1))
    assert extract.month_bounds(2024, 2) == (dt.date(2024, 2, 1), dt.date(2024, 3, 1))


def test_month_extract_pushes_a_range(spark, folder, rows):
    orders = spark.createDataFrame(
        [(1, dt.date(2024, 1, 31)), (2, dt.date(2024, 2, 1)), (3, dt.date(2024, 3, 1))], "order_id bigint, order_date date"
    )
    orders.write.parquet(f"{folder}/o")
    stored = spark.read.parquet(f"{folder}/o")
    month = extract.extract_month(stored, 2024, 2)
    assert rows(month, "order_id") == [(2,)]
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_date,2024-02-01)" in plan and "LessThan(order_date" in plan
    items = spark.createDataFrame([(10, 2), (11, 2), (12, 3)], "order_item_id bigint, order_id bigint")
    assert rows(extract.extract_month_items(items, stored, 2024, 2), "order_item_id", "year", "month") == [
        (10, 2024, 2), (11, 2024, 2)
    ]


def test_jdbc_reads_are_split():
    options = extract.jdbc_options("orders", "jdbc:x", "order_id", 1, 1000, 16)
    assert options["numPartitions"] == "16" and options["partitionColumn"] == "order_id"
