import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import history
from cartwheel.sinks import files, snapshots

T1, T2, T3 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))
SCHEMA = "customer_id bigint, tier string, email string"


def people(spark, *lines):
    return spark.createDataFrame(list(lines), SCHEMA)


def spans(df, rows):
    return rows(df, "customer_id", "tier", "email", history.VALID_FROM, history.VALID_TO)


def test_all_cases(spark, rows):
    first = history.first_snapshot(
        people(spark, (1, "Gold", "a"), (2, "Gold", "b"), (3, "Gold", None), (5, "Gold", "e"), (6, None, None)),
        "customer_id", T1,
    )
    now = people(spark, (1, "Silver", "a"), (2, "Gold", "b"), (3, "Gold", "c"), (4, "Gold", "d"), (6, None, None))
    out = history.scd2_check(first, now, "customer_id", ["tier", "email"], T2)
    assert spans(out, rows) == [
        (1, "Gold", "a", T1, T2), (1, "Silver", "a", T2, None),
        (2, "Gold", "b", T1, None),
        (3, "Gold", None, T1, T2), (3, "Gold", "c", T2, None),
        (4, "Gold", "d", T2, None),
        (5, "Gold", "e", T1, None),
        (6, None, None, T1, None),
    ]


def test_unchecked_columns_do_not_open_rows(spark, rows):
    first = history.first_snapshot(people(spark, (1, "Gold", "a")), "customer_id", T1)
    out = history.scd2_check(first, people(spark, (1, "Gold", "new")), "customer_id", ["tier"], T2)
    assert spans(out, rows) == [(1, "Gold", "a", T1, None)]


def test_same_snapshot_twice_changes_nothing(spark, rows):
    now = people(spark, (1, "Gold", "a"))
    first = history.first_snapshot(now, "customer_id", T1)
    assert spans(history.scd2_check(first, now, "customer_id", ["tier", "email"], T2), rows) == spans(first, rows)


def test_stored_history(spark, folder, rows):
    path = f"{folder}/h"
    for as_of, tier in ((T1, "Gold"), (T2, "Silver"), (T3, "Bronze"), (T3 + dt.timedelta(days=3), "Gold")):
        snapshots.snapshot_table(people(spark, (1, tier, "a"), (2, "Gold", "b")), path, "customer_id", ["tier"], as_of)
    out = snapshots.read_history(spark, path)
    t4 = T3 + dt.timedelta(days=3)
    assert spans(out, rows) == [
        (1, "Bronze", "a", T3, t4), (1, "Gold", "a", T1, T2), (1, "Gold", "a", t4, None), (1, "Silver", "a", T2, T3),
        (2, "Gold", "b", T1, None),
    ]
    assert rows(out.groupBy("closed_month").count()) == [("2024-02", 1), ("2024-03", 2), ("open", 2)]


def test_a_run_that_dies_before_the_switch_leaves_the_old_version(spark, folder, rows, monkeypatch):
    path = f"{folder}/h"
    snapshots.snapshot_table(people(spark, (1, "Gold", "a"), (2, "Gold", "b")), path, "customer_id", ["tier"], T1)
    before = spans(snapshots.read_history(spark, path), rows)
    now = people(spark, (1, "Silver", "a"), (2, "Gold", "b"), (3, "Gold", "c"))
    monkeypatch.setattr(snapshots.Marks, "move", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        snapshots.snapshot_table(now, path, "customer_id", ["tier"], T2)
    monkeypatch.undo()
    assert files.exists(spark, f"{path}/open-000000000002")
    assert spans(snapshots.read_history(spark, path), rows) == before
    # The next run writes over what the dead one left.
    assert snapshots.snapshot_table(now, path, "customer_id", ["tier"], T3) == 2
    assert spans(snapshots.read_history(spark, path), rows) == [
        (1, "Gold", "a", T1, T3), (1, "Silver", "a", T3, None), (2, "Gold", "b", T1, None), (3, "Gold", "c", T3, None)
    ]


def test_old_open_sets_go_and_closed_rows_stay(spark, folder, rows):
    path = f"{folder}/h"
    for month, tier in ((1, "a"), (2, "b"), (3, "c"), (4, "d")):
        snapshots.snapshot_table(people(spark, (1, tier, None)), path, "customer_id", ["tier"], dt.datetime(2024, month, 1))
    assert [n for n in files.names(spark, path) if n.startswith("open")] == ["open-000000000003", "open-000000000004"]
    assert rows(snapshots.read_history(spark, path), "tier", "closed_month") == [
        ("a", "2024-02"), ("b", "2024-03"), ("c", "2024-04"), ("d", "open")
    ]


def test_row_hash_tells_null_from_text(spark):
    pairs = people(spark, (1, None, "a"), (2, "a", None), (3, "null", "a"), (4, "", "a"))
    assert pairs.select(snapshots.row_hash(["tier", "email"])).distinct().count() == 4


def test_dimension_view(spark, rows):
    first = history.first_snapshot(people(spark, (1, "Gold", "a")), "customer_id", T1)
    state = history.scd2_check(first, people(spark, (1, "Silver", "a")), "customer_id", ["tier"], T2)
    view = history.dimension_view(state, "customer_id")
    assert rows(view, "natural_key", "tier", "is_current") == [(1, "Gold", False), (1, "Silver", True)]
    assert view.agg(F.count_distinct("surrogate_key")).first()[0] == 2
