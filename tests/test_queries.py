"""Registered queries against their SQL on the smallest source tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from cartwheel.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
MODELS = {"train_and_score", "next_day_class_metrics", "model_comparison", "feature_importance"}
# The widest compositions; tools/check_queries.py runs all of them.
CHOSEN = [
    "fact_sale_product_daily", "daily_sales", "tier_value", "retention", "category_growth", "best_sellers",
    "session_actions", "user_behavior_3d_features", "session_features", "fact_daily_metrics",
    "product_engagement", "campaign_scores", "merge_orders", "replace_partition", "scd2_customers",
    "stream_ingest_actions", "bronze_csv_orders", "dq_sales", "stream_late_deliveries", "merge_campaign",
]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="source tables not present")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_but_the_models_has_sql():
    assert set(QUERIES) - set(entry.oracle_sql()) == MODELS
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", CHOSEN)
def test_rows_equal_sql(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    result = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(repr(row) for row in result.fetchall())
    assert sorted(repr(tuple(row)) for row in df.select(*columns).collect()) == want
