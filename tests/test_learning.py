import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from cartwheel.operators import learning


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(1)
    lines = []
    for user in range(200):
        for day in (1, 2, 3):
            values = [rng.random() * 5 for _ in learning.DAILY_FEATURES]
            lines.append((user, dt.date(2024, 1, day), int(values[0] + values[1] > 5), *values))
    names = ", ".join(f"{n} double" for n in learning.DAILY_FEATURES)
    df = spark.createDataFrame(lines, f"user_id bigint, prediction_date date, label_purchase_tomorrow int, {names}")
    return df.withColumn("sessions_3d", F.when(F.col("user_id") > 0, F.col("sessions_3d")))


def test_split_depends_on_the_key_alone(features):
    keys = ["user_id", "prediction_date"]
    a, b = learning.split_by_key(features, keys, 0.8)
    c, _ = learning.split_by_key(features.repartition(7, "sessions_3d"), keys, 0.8)
    assert a.count() + b.count() == 600 and 400 < a.count() < 550
    assert a.select(*keys).exceptAll(c.select(*keys)).count() == 0


def test_prepared_fills_nulls_and_drops_unknown_labels(spark):
    df = spark.createDataFrame([(1, None, 1), (2, 3, None)], "k bigint, x int, y int")
    assert [tuple(r) for r in learning.prepared(df, ["x"], "y", ["k"]).collect()] == [(1, 0.0, 1)]


def test_train_score_save_load(spark, features, folder, rows):
    model, test = learning.train_next_day(features, "2024-01-03")
    assert test.agg(F.max("prediction_date")).first()[0] < dt.date(2024, 1, 3)
    assert learning.evaluate(model.transform(test))["auc"] > 0.9
    learning.save_model(model, f"{folder}/m")
    day = dt.date(2024, 1, 3)
    stamp = F.lit(dt.datetime(2024, 1, 4))
    scored = learning.score_day(learning.load_model(f"{folder}/m"), features, day, stamp)
    assert scored.count() == 200
    assert scored.columns == [
        "user_id", "prediction_date", "will_purchase_tomorrow", "purchase_probability", "prediction_timestamp"
    ]
    wrong = scored.where((F.col("purchase_probability") > 0.5).cast("int") != F.col("will_purchase_tomorrow"))
    assert wrong.count() == 0


@pytest.fixture(scope="module")
def sessions(spark):
    rng = random.Random(2)
    lines = []
    for n in range(300):
        values = [float(rng.randint(0, 5)) for _ in learning.SESSION_NUMBERS]
        lines.append((f"s{n}", rng.choice(["vip", "new"]), "social", *values, int(values[6] > 2)))
    names = ", ".join(f"{n} double" for n in learning.SESSION_NUMBERS)
    return spark.createDataFrame(lines, f"session_id string, user_segment string, referrer_type string, {names}, label int")


def test_compare_choose_and_rank(sessions, rows):
    train, test = learning.split_by_key(sessions, ["session_id"], 0.7)
    classifiers = {
        "linear": LogisticRegression(maxIter=20),
        "forest": RandomForestClassifier(numTrees=5, maxDepth=4, seed=1),
    }
    models, metrics = learning.compare_classifiers(train, test, classifiers)
    assert rows(metrics, "model") == [("forest",), ("linear",)]
    assert learning.best_model(metrics).count() == 1
    ranked = learning.feature_importance(models["forest"])
    assert ranked.count() == 20 and ranked.first().feature == "num_add_to_cart"
    scored = models["forest"].transform(test)
    assert learning.confusion(scored).agg(F.sum("rows")).first()[0] == test.count()


def test_class_metrics(spark, rows):
    pairs = [(1, 1)] * 3 + [(1, 0)] + [(0, 0)] * 4 + [(0, 1)] * 2
    scored = spark.createDataFrame([(a, float(p)) for a, p in pairs], "label int, prediction double")
    out = {r[0]: r[1:] for r in rows(learning.class_metrics(scored))}
    assert out[1] == pytest.approx((0.6, 0.75, 2 * 0.6 * 0.75 / 1.35))
    assert out[0] == pytest.approx((0.8, 4 / 6, 2 * 0.8 * (4 / 6) / (0.8 + 4 / 6)))


def test_weights_balance_the_classes(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 6, "label int")
    sums = learning.with_class_weights(df).groupBy("label").agg(F.sum("class_weight")).collect()
    assert {r[0]: round(r[1], 9) for r in sums} == {1: 4.0, 0: 4.0}


@pytest.mark.parametrize("folds", [2, None])
def test_tuning(sessions, folds):
    logistic = LogisticRegression(maxIter=5)
    pipeline = Pipeline(stages=[*learning.session_stages(), logistic])
    grid = ParamGridBuilder().addGrid(logistic.regParam, [0.01, 10.0]).build()
    best = learning.tuned(pipeline, grid, sessions, folds)
    assert best.bestModel.stages[-1].getRegParam() == 0.01


class Threshold:
    def predict_proba(self, matrix):
        share = matrix[:, 0] / 10
        return np.column_stack([1 - share, share])

    def predict(self, matrix):
        return self.predict_proba(matrix)[:, 1] > 0.5


def test_outside_model_scores_every_row(spark, rows):
    df = spark.createDataFrame([(1, 8.0), (2, None), (3, 2.0)], "user_id bigint, x double")
    out = learning.score_rows(df.repartition(3), Threshold(), ["x"], ["user_id"])
    assert rows(out) == [(1, 1, 0.8), (2, 0, 0.0), (3, 0, 0.2)]


def test_metadata(spark, folder):
    metrics = {"auc": 0.8, "accuracy": 0.7, "f1": 0.6}
    learning.write_model_metadata(spark, f"{folder}/meta", "forest", metrics, dt.date(2024, 1, 1), ["a", "b"], ["b"])
    row = json.loads(spark.read.text(f"{folder}/meta").first()[0])
    assert row["num_features"] == 2 and row["top_10_features"] == ["b"] and row["f1_score"] == 0.6
