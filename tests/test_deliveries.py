"""Session records that come late, twice, corrected and out of order."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from cartwheel.streaming import deliveries
from tests.logs import action, frame, session

HOUR = dt.timedelta(hours=1)
VIEW, CART = action("view", 0, product_id=1), action("add_to_cart", 5, product_id=1)


def land(spark, folder, *lines):
    """``(session, time sent)`` pairs as one landing."""
    for record, sent in lines:
        rows = frame(spark, record).drop("ingest_date").withColumn("delivered_at", F.lit(sent).cast("timestamp"))
        rows.coalesce(1).write.mode("append").json(f"{folder}/in")


def run(spark, folder):
    deliveries.merge_deliveries(spark, f"{folder}/in", f"{folder}/sessions", f"{folder}/actions", f"{folder}/c")
    return spark.read.parquet(f"{folder}/sessions"), spark.read.parquet(f"{folder}/actions")


def test_the_newest_delivery_wins_in_any_order(spark, folder, rows):
    first, corrected = session("a", 1, actions=[VIEW, CART]), session("a", 2, actions=[VIEW])
    land(spark, folder, (corrected, "2024-01-01 12:00:00"), (session("b", 3, actions=[VIEW]), "2024-01-01 11:00:00"))
    run(spark, folder)
    land(spark, folder, (first, "2024-01-01 11:00:00"), (session("b", 4, actions=[CART, VIEW]), "2024-01-01 12:00:00"))
    sessions, actions = run(spark, folder)
    assert rows(sessions, "session_id", "user_id") == [("a", 2), ("b", 4)]
    assert rows(actions, "session_id", "action_type") == [("a", "view"), ("b", "add_to_cart"), ("b", "view")]


def test_a_correction_takes_actions_away_and_moves_a_late_session(spark, folder, rows):
    land(spark, folder, (session("a", 1, actions=[VIEW, CART]), "2024-01-01 11:00:00"), (session("b", 1, actions=[VIEW]), "2024-01-04 09:00:00"))
    sessions, _ = run(spark, folder)
    assert rows(sessions, "session_id", "day") == [("a", 1), ("b", 4)]
    land(spark, folder, (session("a", 1, actions=[]), "2024-01-03 00:00:00"))
    sessions, actions = run(spark, folder)
    assert rows(sessions, "session_id", "day") == [("a", 3), ("b", 4)]
    assert rows(actions, "session_id") == [("b",)]


def test_repeats_write_nothing(spark, folder):
    one = session("a", 1, actions=[VIEW])
    land(spark, folder, (one, "2024-01-01 11:00:00"))
    run(spark, folder)
    land(spark, folder, (one, "2024-01-01 15:00:00"), (one, "2024-01-01 10:30:00"))
    sessions, _ = run(spark, folder)
    assert str(sessions.first().delivered_at) == "2024-01-01 11:00:00"


def batch_of(spark, *lines):
    rows = None
    for record, sent in lines:
        one = frame(spark, record).drop("ingest_date").withColumn("delivered_at", F.lit(sent).cast("timestamp"))
        rows = one if rows is None else rows.unionByName(one)
    return deliveries.delivered(rows.select(F.to_json(F.struct("*")).alias("value")))


def test_a_replayed_batch_changes_nothing(spark, folder, rows, monkeypatch):
    batch = batch_of(
        spark, (session(None, 7, actions=[VIEW]), "2024-01-01 11:00:00"), (session(None, 7, actions=[VIEW]), "2024-01-01 11:00:00"),
        (session("a", 1, actions=[VIEW]), "2024-01-01 11:00:00"),
    )
    paths = (f"{folder}/s", f"{folder}/a")
    # The first try dies between the two tables.
    merge, tries = deliveries.merge_into, []

    def dies_second(*given, **named):
        tries.append(1)
        if len(tries) == 2:
            raise RuntimeError("lost")
        return merge(*given, **named)

    monkeypatch.setattr(deliveries, "merge_into", dies_second)
    try:
        deliveries.merge_batch(batch, *paths, "t-0", 2 * HOUR)
    except RuntimeError:
        pass
    monkeypatch.undo()
    for _ in range(2):
        deliveries.merge_batch(batch, *paths, "t-0", 2 * HOUR)
        assert rows(spark.read.parquet(paths[0]), "user_id") == [(1,), (7,), (7,)]
        assert rows(spark.read.parquet(paths[1]), "session_id") == [(None,), (None,), ("a",)]


def test_old_records_change_nothing_after_the_state_forgot(spark, folder, rows):
    paths = (f"{folder}/s", f"{folder}/a")
    for n, (user, sent) in enumerate([(1, "2024-01-01 12:00:00"), (2, "2024-01-01 11:00:00"), (3, "2024-01-01 12:00:00")]):
        deliveries.merge_batch(batch_of(spark, (session("a", user, actions=[VIEW] * user), sent)), *paths, f"t-{n}", 2 * HOUR)
    assert rows(spark.read.parquet(paths[0]), "user_id") == [(1,)]
    assert spark.read.parquet(paths[1]).count() == 1


class State:
    def __init__(self):
        self.value, self.hasTimedOut = None, False

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, millis):
        self.due = millis


def test_what_the_state_lets_through():
    def give(state, *pairs):
        frames = [pd.DataFrame([(*p, "v") for p in pairs], columns=["sent", "content", "value"])]
        return [(int(r.sent.iloc[0]), int(r.content.iloc[0])) for r in deliveries._newest_of_state(("a",), frames, state, HOUR)]

    state = State()
    assert give(state, (5, 1), (3, 1)) == [(3, 1)] and state.value == (5, 1)
    assert give(state, (5, 1), (4, 9)) == []
    assert give(state, (9, 1)) == [] and state.value == (9, 1)
    assert give(state, (9, 2), (8, 7)) == [(9, 2)]
    assert give(state, (10, 3), (11, 2), (12, 2)) == [(11, 2)]
    assert state.due == 3_600_000
    state.hasTimedOut = True
    assert give(state) == [] and state.value is None


def test_filing_day(spark, rows):
    sent = ["2024-01-01 10:30:00", "2024-01-02 01:59:59", "2024-01-02 02:00:00", "2024-01-09 00:00:00", None]
    df = spark.createDataFrame([("2024-01-01T10:00:00Z", s) for s in sent], "timestamp string, delivered_at string")
    days = df.withColumn("delivered_at", F.col("delivered_at").cast("timestamp")).select(deliveries.filing_day().alias("d")).collect()
    assert [str(r.d) for r in days] == ["2024-01-01", "2024-01-01", "2024-01-02", "2024-01-09", "2024-01-01"]


def test_lines_without_a_record_are_left_out(spark):
    lines = spark.createDataFrame([("not json",), ("{}",), ('{"session_id": "a"}',)], "value string")
    assert [r.session_id for r in deliveries.delivered(lines).collect()] == ["a"]
