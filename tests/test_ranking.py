"""Ranks, exact quantiles, evaluation and the run log."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import activity, evaluation, oltp, ranking, session_features
from cartwheel.plans import slices
from cartwheel.schemas import BRONZE_CSV, LANDED_LOG
from cartwheel.sinks import tables
from tests.logs import action, frame, session


def brute_quantile(values, share):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[max(1, math.ceil(Decimal(str(share)) * len(kept))) - 1]


VALUES = {
    "spread": [random.Random(1).gauss(0, 1e6) for _ in range(3000)],
    "two values": [0.0] * 1200 + [1.0] * 1800,
    "one value": [7.5] * 500,
    "hot middle": [float(i) for i in range(400)] + [200.0] * 2000,
    "nulls": [None, float("nan"), *map(float, range(999)), None],
    "wide": [10.0 ** random.Random(i).randint(-300, 300) for i in range(2000)],
}


@pytest.mark.parametrize("name", list(VALUES))
def test_exact_quantiles(spark, name):
    df = spark.createDataFrame([(v,) for v in VALUES[name]], "x double").repartition(5)
    shares = [0.0, 0.05, 0.4, 0.5, 0.95, 1.0]
    # A coarse sketch and few rows at once force many passes.
    found = ranking.exact_quantiles(df, "x", shares, accuracy=20, at_once=10)
    assert found == [brute_quantile(VALUES[name], s) for s in shares]


def test_quantiles_of_nothing(spark):
    none = spark.createDataFrame([(None,)], "x double")
    assert ranking.exact_quantiles(none, "x", [0.5]) == [None]
    assert [r.x for r in session_features.winsorised(none, "x", 0.05, 0.95).collect()] == [None]


def test_positions_and_running_totals(spark, rows):
    df = spark.range(500, numPartitions=6).selectExpr("(id * 7919) % 500 AS k", "id % 3 AS n")
    placed = ranking.positions(df, ["k"]).collect()
    assert sorted((r.position, r.k) for r in placed) == [(i, i) for i in range(500)]
    summed = sorted((r.k, r.n, r.n_before) for r in ranking.running_totals(df, "k", ["n"]).collect())
    total = 0
    for _, n, before in summed:
        assert before == total
        total += n


def pairs(seed, n, levels):
    draw = random.Random(seed)
    return [(("a", "b")[i % 2], draw.choice([0, 1, 1]), draw.randint(0, levels) / levels) for i in range(n)]


def scored(spark, lines):
    return spark.createDataFrame(lines, "model string, label int, score double").repartition(4)


def brute_auc(lines, model):
    positive = [s for m, y, s in lines if m == model and y == 1]
    negative = [s for m, y, s in lines if m == model and y == 0]
    wins = sum((p > n) + (p == n) / 2 for p in positive for n in negative)
    return wins / (len(positive) * len(negative))


@pytest.mark.parametrize("levels", [1, 5, 1000])
def test_auc_with_ties(spark, levels):
    lines = pairs(2, 300, levels)
    found = {r.model: r.auc for r in evaluation.auc(scored(spark, [*lines, ("a", None, 0.3), ("b", 1, None)])).collect()}
    assert found == pytest.approx({m: brute_auc(lines, m) for m in "ab"}, abs=1e-12)


def test_auc_of_one_class_is_unknown(spark):
    out = evaluation.auc(scored(spark, [("a", 1, 0.1), ("a", 1, 0.2)])).collect()
    assert [(r.positives, r.negatives, r.auc) for r in out] == [(2, 0, None)]
    assert evaluation.auc(scored(spark, [])).collect() == []


def test_threshold_sweep(spark):
    lines = pairs(3, 200, 8)
    for r in evaluation.threshold_sweep(scored(spark, lines)).collect():
        named = [y for m, y, s in lines if m == r.model and s >= r.threshold]
        actual = sum(y for m, y, _ in lines if m == r.model)
        assert (r.hits, r.false_alarms) == (sum(named), len(named) - sum(named))
        assert (r.precision, r.recall) == pytest.approx((sum(named) / len(named), sum(named) / actual))
    best = {r.model: r.f1 for r in evaluation.best_threshold(scored(spark, lines)).collect()}
    sweep = evaluation.threshold_sweep(scored(spark, lines)).groupBy("model").agg(F.max("f1")).collect()
    assert best == {r[0]: r[1] for r in sweep}


def test_permuted_keeps_values_and_can_be_repeated(spark, rows):
    df = spark.range(200).selectExpr("id AS k", "id * 2 AS x", "id % 5 AS y")
    one = evaluation.permuted(df.repartition(3), ["k"], "x")
    two = evaluation.permuted(df.repartition(7), ["k"], "x")
    assert rows(one) == rows(two) and one.columns == df.columns
    assert sorted(r.x for r in one.collect()) == list(range(0, 400, 2))
    assert one.where("x <> 2 * k").count() > 150 and one.where("y <> k % 5").count() == 0


def test_permutation_importance_finds_the_input_that_matters(spark):
    df = spark.range(400).selectExpr("id AS k", "(id * 7919) % 400 AS x", "id % 7 AS y", "int((id * 7919) % 400 >= 200) AS label")
    found = evaluation.permutation_importance(df, ["k"], ["x", "y"], lambda: F.col("x").cast("double") + 0 * F.col("y"))
    assert [r.feature for r in found.collect()] == ["x", "y"]
    x, y = (r.importance for r in found.collect())
    assert 0.35 < x < 0.65 and y == 0.0


def test_run_log(spark, folder):
    path = f"{folder}/t"
    df = spark.createDataFrame([(1, 2023, 12), (2, 2024, 1), (3, 2024, 11), (4, None, 1)], "id int, year int, month int")
    tables.write_partitions(df, path, ["year", "month"])
    available = slices.partition_slices(spark, path, ("year", "month"))
    assert available == ["2023-12", "2024-01", "2024-11"]
    log = slices.RunLog(spark, f"{folder}/runs")
    assert log.next("job", available) == "2023-12" and log.high_water("job") is None
    done = []
    log.record("job", "2024-01")
    assert log.next("job", available) == "2024-11" and log.missed("job", available) == ["2023-12"]
    assert log.catch_up("job", available, done.append) == done == ["2023-12", "2024-11"]
    assert log.next("job", available) is None and log.next("other", available) == "2023-12"


def test_a_slice_that_fails_is_done_again(spark, folder):
    log = slices.RunLog(spark, f"{folder}/runs")

    def work(one):
        if one == "b":
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        log.catch_up("job", ["a", "b", "c"], work)
    assert log.done("job") == ["a"] and log.next("job", ["a", "b", "c"]) == "b"


def test_sliced_reads_prune_partitions(spark, folder):
    orders = spark.createDataFrame([("1", "1", "2024-01-05", "1", "1", "", "")], BRONZE_CSV["orders"]).selectExpr("*", "2024 AS year", "1 AS month")
    tables.write_partitions(orders, f"{folder}/orders", ["year", "month"])
    one = oltp.orders(spark.read.parquet(f"{folder}/orders"), 2024, 1)
    frame(spark, session("a", actions=[action("view")])).write.partitionBy("ingest_date").parquet(f"{folder}/logs")
    two = activity.session_actions(spark.read.schema(LANDED_LOG).parquet(f"{folder}/logs"), "2024-01-01")
    for df, columns in ((one, ("year", "month")), (two, ("ingest_date",))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        filters = plan.split("PartitionFilters: [", 1)[1].split("], PushedFilters")[0]
        assert all(f"{c}#" in filters for c in columns), filters
        assert df.count() == 1
