"""Steps whose tasks, calls or files must not grow with the input."""

import datetime as dt
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartwheel.plans import stored_queries
from cartwheel.plans.queries import Shop
from cartwheel.session import INITIAL, Scratch, spread
from cartwheel.sources import shop_tables
from cartwheel.streaming import deliveries, ingest
from tests.logs import action, frame, session
from tests.test_deliveries import State

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_a_small_file_of_many_events_is_made_into_records_by_many_tasks(spark, folder):
    events = spark.range(60_000).selectExpr(
        "id AS event_id", "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts", "id % 9 AS user_id",
        "'view' AS event_type", "1D AS value", "'{\"k\": 1}' AS props",
    )
    events.coalesce(1).write.parquet(f"{folder}/events.parquet")
    logs = shop_tables.activity_logs(spark, folder)
    sizes = [r["count"] for r in logs.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert len(sizes) == 3 and sum(sizes) == 60_000 and max(sizes) < 25_000


def test_few_rows_are_not_shuffled(spark):
    rows = spark.range(10)
    assert spread(rows, 10, "id") is rows


@pytest.fixture
def settings(spark):
    before = {name: spark.conf.get(name, None) for name in (INITIAL, ADVISORY)}
    yield spark.conf
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_shuffles_of_order_lines_grow_with_them(spark, folder, settings):
    settings.unset(INITIAL)
    lines = spark.range(1_000_000).selectExpr(
        "id AS l_orderkey", "1 AS l_linenumber", "id AS l_partkey", "1D AS l_quantity", "1D AS l_extendedprice", "0D AS l_discount"
    )
    lines.write.parquet(f"{folder}/lineitem.parquet")
    Shop(spark, folder).bronze("order_items")
    assert settings.get(INITIAL) == "20"


def given(state, now, *rows):
    columns = ["session_id", "sent", "content", "value", "bucket"]
    frames = [pd.DataFrame([(*r, 0)], columns=columns) for r in rows]
    out = [*deliveries._newest_of_bucket(frames, state, dt.timedelta(hours=1), now)]
    return sorted(tuple(r) for f in out for r in f.itertuples(index=False))


def test_a_bucket_lets_through_what_the_state_of_each_session_does():
    draw, bucket, each = random.Random(1), State(), {}
    for n in range(30):
        rows = [(draw.choice("abc"), draw.randrange(9), draw.randrange(3), f"{n}-{i}") for i in range(draw.randrange(1, 8))]
        one = []
        for key in sorted({r[0] for r in rows}):
            frames = [pd.DataFrame([r for r in rows if r[0] == key], columns=["session_id", "sent", "content", "value"])]
            for f in deliveries._newest_of_state((key,), frames, each.setdefault(key, State()), dt.timedelta(hours=1)):
                one += [tuple(r)[:3] for r in f.itertuples(index=False)]
        assert [r[:3] for r in given(bucket, n, *rows)] == one


def test_a_bucket_forgets_sessions_and_keeps_nameless_rows():
    state = State()
    frames = [pd.DataFrame([("a", 5, 1, "v", 0), (None, 1, 1, "w", 0), (None, 1, 1, "w", 0)], columns=["session_id", "sent", "content", "value", "bucket"])]
    out = pd.concat(deliveries._newest_of_bucket(frames, state, dt.timedelta(hours=1), 0))
    assert out["value"].tolist() == ["v", "w", "w"]
    assert [*deliveries._unpacked(state.value[0])] == ["a"] and state.due == 3_600_000
    assert given(state, 3_600_000, ("b", 5, 1, "v")) == [("b", 5, 1, "v")]
    assert [*deliveries._unpacked(state.value[0])] == ["b"]
    state.hasTimedOut = True
    assert given(state, 9_000_000) == [] and state.value is None


def test_landed_days_get_few_files(spark, folder):
    for n in range(4):
        day = [session(f"{n}-{d}", 1, f"2024-01-0{d + 1}T10:00:00Z", [action("view", 0)]) for d in range(5)]
        frame(spark, *day).drop("ingest_date").coalesce(1).write.mode("append").json(f"{folder}/in")
    ingest.ingest_logs(spark, f"{folder}/in", f"{folder}/logs", f"{folder}/c")
    logs = spark.read.parquet(f"{folder}/logs")
    assert logs.count() == 20 and len(logs.inputFiles()) == 5


def test_copies_end_with_their_block(spark):
    with pytest.raises(ValueError):
        with Scratch(spark) as scratch:
            kept = scratch.keep(spark.range(10), "kept")
            scratch.keep(spark.range(5), "dropped")
            paths = dict(scratch.paths)
            scratch.drop("dropped")
            assert kept.count() == 10 and os.path.exists(paths["kept"]) and not os.path.exists(paths["dropped"])
            raise ValueError
    assert not any(map(os.path.exists, paths.values()))


def test_a_merge_leaves_no_copies_in_the_shared_folder(spark, folder):
    shared = f"{spark.conf.get('spark.checkpoint.dir')}/cartwheel"
    before = set(os.listdir(shared)) if os.path.exists(shared) else set()
    for n in range(2):
        for at in range(3):
            late = frame(spark, session(f"s{at}", n, actions=[action("view", 0)])).drop("ingest_date")
            late.withColumn("delivered_at", F.lit(f"2024-01-0{n + 2} 12:00:00").cast("timestamp")).write.mode("append").json(f"{folder}/in", compression="gzip")
        deliveries.merge_deliveries(spark, f"{folder}/in", f"{folder}/s", f"{folder}/a", f"{folder}/c")
    assert sorted(r.user_id for r in spark.read.parquet(f"{folder}/s").collect()) == [1, 1, 1]
    assert spark.read.parquet(f"{folder}/a").count() == 3
    assert set(os.listdir(shared) if os.path.exists(shared) else ()) == before


def test_lines_are_only_shuffled_if_a_session_has_several(spark):
    def newest(*lines):
        rows = deliveries._newest_lines(spark.createDataFrame([*lines], "session_id string, sent bigint, content bigint, value string"))
        return sorted(r.value for r in rows.collect()), "Exchange" in rows._jdf.queryExecution().executedPlan().toString()

    assert newest(("a", 1, 1, "u"), ("b", 1, 1, "v"), (None, 1, 1, "w"), (None, 1, 1, "w")) == (["u", "v", "w", "w"], False)
    assert newest(("a", 1, 2, "u"), ("a", 2, 1, "v"), ("a", 2, 1, "t"), (None, 1, 1, "w")) == (["v", "w"], True)


def test_the_settings_of_the_stream_do_not_stay(spark, folder):
    before = {key: spark.conf.get(key) for key in deliveries.STREAM}
    frame(spark, session("a", 1)).drop("ingest_date").withColumn("delivered_at", F.lit("2024-01-01 12:00:00").cast("timestamp")).write.json(f"{folder}/in")
    deliveries.merge_deliveries(spark, f"{folder}/in", f"{folder}/s", f"{folder}/a", f"{folder}/c")
    assert {key: spark.conf.get(key) for key in deliveries.STREAM} == before


def test_landed_deliveries_are_packed(spark, folder, monkeypatch):
    events = spark.range(60).selectExpr("id AS event_id", "timestamp'2024-01-01 10:00:00' AS ts", "id % 7 AS user_id", "'purchase' AS event_type", "1D AS value", """concat('{"k": ', id, '}') AS props""")
    events.write.parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(stored_queries, "shared_dir", lambda spark, label: f"{folder}/{label}")
    assert stored_queries.stream_late_deliveries(Shop(spark, folder)).count() > 0
    landed = [name for name in os.listdir(f"{folder}/landing") if name.startswith("part-")]
    assert landed and all(name.endswith(".json.gz") for name in landed)
