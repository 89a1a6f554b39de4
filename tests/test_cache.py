import datetime as dt

import pytest

from cartwheel.sinks import cache, files, tables

NOW = dt.datetime(2024, 1, 1, 12)


def counting(spark, made):
    def build():
        made.append(1)
        return spark.range(len(made)).selectExpr("id AS k")

    return build


def test_rows_are_kept_until_they_expire(spark, folder):
    store, made = cache.TableCache(spark, folder), []
    for hours, builds in ((0, 1), (1, 1), (7 * 24 - 1, 1), (7 * 24, 2), (7 * 24 + 1, 2)):
        rows = store.get("t", counting(spark, made), NOW + dt.timedelta(hours=hours))
        assert (len(made), rows.count()) == (builds, builds)


def test_changed_inputs_build_anew(spark, folder):
    store, made = cache.TableCache(spark, f"{folder}/cache"), []
    path = f"{folder}/t"
    rows = spark.createDataFrame([(1, 2024)], "id int, year int")
    for builds in (1, 1):
        tables.merge_into(rows, path, ["id"], ["year"], token="a")  # merged once
        store.get("t", counting(spark, made), NOW, store.inputs_of({"t": path}))
        assert len(made) == builds
    tables.merge_into(rows, path, ["id"], ["year"], token="b")
    store.get("t", counting(spark, made), NOW, store.inputs_of({"t": path}))
    assert len(made) == 2


def test_a_build_that_dies_does_not_count(spark, folder):
    store = cache.TableCache(spark, folder)
    with pytest.raises(ZeroDivisionError):
        store.get("t", lambda: 1 / 0, NOW)
    spark.range(5).write.parquet(f"{folder}/t/build-000000000001")
    made = []
    assert store.get("t", counting(spark, made), NOW).count() == 1 and made == [1]


def test_sweep(spark, folder):
    store, made = cache.TableCache(spark, folder), []
    store.get("a", counting(spark, made), NOW)
    store.get("a", counting(spark, made), NOW, {"x": "2"})
    store.get("b", counting(spark, made), NOW + dt.timedelta(days=3))
    assert store.sweep(NOW) == ["a/1"]
    assert store.sweep(NOW + dt.timedelta(days=8)) == ["a/2"]
    assert store.builds("a") == [] and store.builds("b") == [1]
    assert not [n for n in files.names(spark, f"{folder}/a") if n.startswith("build")]
