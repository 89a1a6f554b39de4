"""Upserts that find old rows in the key index, and what they log."""

import datetime as dt
import os

import pytest

from cartwheel.sinks import files, tables
from cartwheel.sinks.key_index import KeyIndex
from cartwheel.sinks.versions import ChangeLog, Marks

COLUMNS = "id bigint, value string, year int, month int"
KEY, PLACE = ["id"], ["year", "month"]


def frame(spark, *lines):
    return spark.createDataFrame(list(lines), COLUMNS)


def merge(spark, path, *lines, **options):
    return tables.merge_into(frame(spark, *lines), path, KEY, PLACE, **options)


def index_of(spark, path, **sizes):
    return KeyIndex.of(frame(spark), path, KEY, PLACE, **sizes)


@pytest.fixture
def target(spark, folder):
    path = f"{folder}/t"
    merge(spark, path, *[(i, "a", 2024, 1 + i % 4) for i in range(40)])
    return path


def agrees(spark, path, rows):
    stored = spark.read.schema(COLUMNS).parquet(path).where("id IS NOT NULL")
    assert rows(index_of(spark, path).entries(), "id", *PLACE) == rows(stored, "id", *PLACE)


def test_index_follows_new_moved_and_changed_keys(spark, target, rows):
    agrees(spark, target, rows)
    merge(spark, target, (1, "b", 2024, 2), (2, "b", 2024, 4), (50, "n", 2025, 1), (None, "x", 2024, 1))
    merge(spark, target, (1, "c", 2024, 3), (50, "n", None, None))
    agrees(spark, target, rows)


def test_rows_changed_in_place_add_no_entries(spark, target):
    merge(spark, target, (1, "b", 2024, 2), (2, "b", 2024, 3))
    assert spark.read.parquet(f"{target}.keys/delta-000000000002").count() == 0


def test_a_rebuilt_index_agrees(spark, target, rows):
    merge(spark, target, (3, "b", 2024, 1), (60, "n", 2024, 2))
    kept = rows(index_of(spark, target).entries())
    index_of(spark, target).rebuild(spark.read.schema(COLUMNS).parquet(target))
    assert rows(index_of(spark, target).entries()) == kept
    assert [n[:5] for n in files.names(spark, f"{target}.keys")] == ["base-"]
    merge(spark, target, (3, "c", 2024, 4))
    agrees(spark, target, rows)


def test_a_table_without_an_index_gets_one(spark, target, rows):
    files.delete(spark, f"{target}.keys")
    merge(spark, target, (5, "b", 2024, 4))
    assert rows(spark.read.schema(COLUMNS).parquet(target).where("id = 5"), "value", "month") == [("b", 4)]
    agrees(spark, target, rows)


def test_untouched_partitions_are_not_read(spark, target):
    # Any read of this file fails.
    with open(f"{target}/year=2024/month=4/part-bad.parquet", "w") as bad:
        bad.write("not parquet")
    merge(spark, target, (0, "b", 2024, 2), (70, "n", 2024, 1))
    with pytest.raises(Exception):
        merge(spark, target, (3, "b", 2024, 1))


def test_a_lookup_reads_only_the_buckets_of_its_keys(spark, target):
    index = index_of(spark, target, buckets=64)
    index.rebuild(spark.read.schema(COLUMNS).parquet(target))
    plan = index._entries([3, 5])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan.split("PartitionFilters")[1][:200]
    located = index.locate(frame(spark, (1, None, None, None), (99, None, None, None)))
    assert [tuple(r) for r in located.collect()] == [(1, 2024, 2)]


def test_deltas_are_folded(spark, target, rows):
    index = index_of(spark, target, deltas=3, buckets=8)
    assert not index.fold()
    for number in range(2):
        merge(spark, target, (80 + number, "n", 2024, 1), (1, "m", 2024, 3 + number))
    assert index.fold()
    assert files.names(spark, f"{target}.keys") == ["base-000000000003"]
    assert rows(index.entries(), "id", "month")[1] == (1, 4)
    assert index.next_number() == 4


def test_a_half_written_base_is_no_base(spark, target, rows):
    os.makedirs(f"{target}.keys/base-000000000009")
    agrees(spark, target, rows)


def test_two_columns_as_key(spark, folder, rows):
    schema = "customer_id bigint, day date, score double, year int, month int"
    d1, d2 = dt.date(2024, 1, 31), dt.date(2024, 2, 1)
    path = f"{folder}/c"
    first = [(1, d1, 0.1, 2024, 1), (1, d2, 0.2, 2024, 2), (2, d1, 0.3, 2024, 1)]
    for batch in (first, [(1, d2, 0.9, 2024, 2), (3, None, 0.5, 2024, 1)]):
        tables.merge_into(spark.createDataFrame(batch, schema), path, ["customer_id", "day"], PLACE)
    assert rows(spark.read.schema(schema).parquet(path), "customer_id", "day", "score") == [
        (1, d1, 0.1), (1, d2, 0.9), (2, d1, 0.3), (3, None, 0.5)
    ]


def test_a_batch_merged_before_is_left_out(spark, target, rows):
    assert merge(spark, target, (None, "x", 2024, 1), (1, "b", 2024, 2), token="s-0")
    assert not merge(spark, target, (None, "x", 2024, 1), (1, "b", 2024, 2), token="s-0")
    assert merge(spark, target, (None, "x", 2024, 1), token="s-1")
    assert spark.read.schema(COLUMNS).parquet(target).where("id IS NULL").count() == 2


def test_a_replay_after_a_crash_is_left_out_too(spark, target, monkeypatch):
    monkeypatch.setattr(tables, "write_partitions", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        merge(spark, target, (None, "x", 2024, 1), token="s-0")
    monkeypatch.undo()
    assert not merge(spark, target, (None, "x", 2024, 1), token="s-0")
    assert spark.read.schema(COLUMNS).parquet(target).where("id IS NULL").count() == 1


def test_removed_keys_leave_and_a_key_may_have_several_rows(spark, target, rows):
    gone = frame(spark, (4, None, None, None), (8, None, None, None)).select("id")
    batch = frame(spark, (5, "p", 2024, 3), (5, "q", 2024, 3))
    tables.merge_into(batch, target, KEY, PLACE, removed=gone)
    out = spark.read.schema(COLUMNS).parquet(target)
    assert rows(out.where("id IN (4, 5, 8)"), "id", "value") == [(5, "p"), (5, "q")]
    assert out.count() == 39


def test_stored_rows_of_a_batch(spark, target, rows):
    found = tables.stored_rows(frame(spark, (1, "z", 2030, 1), (99, "z", 2030, 1)), target, KEY, PLACE, ["value", "month"])
    assert rows(found) == [(1, "a", 2)]
    assert tables.stored_rows(frame(spark), f"{target}-none", KEY, PLACE, []) is None
    late = tables.newest(frame(spark, (1, "0", 1, 1), (2, "b", 1, 1), (99, "0", 1, 1)), frame(spark, (1, "a", 1, 1), (2, "a", 1, 1)), KEY, "value")
    assert rows(late, "id") == [(2,), (99,)]


def test_changes_and_marks(spark, target, folder, rows):
    log, marks = ChangeLog(spark, target), Marks(spark, f"{folder}/marks")
    first, mark = log.since(marks.read("features"))
    assert rows(first) == [(2024, m) for m in (1, 2, 3, 4)] and mark == 1
    marks.move("features", mark)
    merge(spark, target, (1, "b", 2024, 4))
    merge(spark, target, (2, "b", 2024, 3))
    news, mark = log.since(marks.read("features"))
    assert rows(news) == [(2024, 2), (2024, 3), (2024, 4)] and mark == 3
    marks.move("features", mark)
    assert log.since(marks.read("features")) == (None, 3)
    assert marks.least(["features", "other"]) == 0
    log.forget(marks.read("features"))
    assert log.numbers() == [3]
    merge(spark, target, (3, "b", 2024, 4))
    assert log.numbers() == [3, 4]
