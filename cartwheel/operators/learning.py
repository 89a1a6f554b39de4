"""Training, scoring and evaluating purchase models with Spark ML."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, TrainValidationSplit
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from cartwheel.functions.scalars import as_double, flag
from cartwheel.operators.predictions import before_day, on_day

# Inputs of the next-day model.
DAILY_FEATURES = (
    "purchase_count_3d", "add_to_cart_count_3d", "checkout_view_count_3d",
    "cart_conversion_rate_3d", "purchase_conversion_rate_3d",
    "sessions_3d", "total_duration_3d", "avg_session_duration_3d",
    "total_actions_3d", "actions_per_session_3d",
    "distinct_products_3d", "avg_product_price_3d",
)
# Session model inputs: the columns session_features() provides, without
# those that state the label itself.
SESSION_CATEGORIES = ("user_segment", "referrer_type")
SESSION_NUMBERS = (
    "duration_seconds", "page_views", "actions_count", "action_velocity", "avg_time_per_page",
    "num_views", "num_add_to_cart", "num_wishlist", "num_searches", "num_reviews",
    "num_remove_from_cart", "has_checkout_view", "cart_conversion_rate",
    "unique_products_viewed", "unique_categories_viewed", "avg_product_price",
    "max_price_viewed", "min_price_viewed", "price_range_interest",
    "hour_of_day", "is_weekend", "is_mobile",
)


def prepared(features: DataFrame, inputs: Sequence[str], label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Keys, inputs as doubles with NULL as 0, integer label; rows without a
    label are dropped."""
    return features.select(
        *keys,
        *[F.coalesce(as_double(name), F.lit(0.0)).alias(name) for name in inputs],
        F.col(label).cast("int").alias("label"),
    ).where(F.col("label").isNotNull())


def split_by_key(df: DataFrame, keys: Sequence[str], share: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts, the first holding about ``share`` of the rows.

    Membership depends on the row's key alone, so a task re-run after a lost
    executor puts every row on the same side again.
    """
    bucket = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(10_000))
    first = bucket < int(share * 10_000)
    return df.where(first), df.where(~first)


def next_day_pipeline(inputs: Sequence[str] = DAILY_FEATURES) -> Pipeline:
    """Assemble, scale by deviation, logistic regression with ridge penalty."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(inputs), outputCol="raw", handleInvalid="skip"),
            StandardScaler(inputCol="raw", outputCol="features", withStd=True, withMean=False),
            LogisticRegression(
                maxIter=100, regParam=0.01, elasticNetParam=0.0, family="binomial", threshold=0.5
            ),
        ]
    )


def train_next_day(
    features: DataFrame, cut_off: dt.date | str, share: float = 0.8, seed: int = 42
) -> tuple[PipelineModel, DataFrame]:
    """Model fitted on part of the rows before the cut-off, and the rest as
    test rows.  ``share=1`` fits on all of them."""
    keys = ("user_id", "prediction_date")
    rows = prepared(
        before_day(features, "prediction_date", cut_off), DAILY_FEATURES, "label_purchase_tomorrow", keys
    )
    train, test = split_by_key(rows, keys, share, seed)
    return fit(next_day_pipeline(), train), test


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fits on rows kept in executor memory (spilling to disk) for the many
    passes of the optimiser."""
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline.fit(train)
    finally:
        train.unpersist()


def score(model: PipelineModel, features: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Class and probability of a purchase for every feature row."""
    keys = ("user_id", "prediction_date")
    rows = features.select(
        *keys, *[F.coalesce(F.nanvl(as_double(name), F.lit(0.0)), F.lit(0.0)).alias(name) for name in DAILY_FEATURES]
    )
    return model.transform(rows).select(
        *keys,
        F.col("prediction").cast("int").alias("will_purchase_tomorrow"),
        vector_to_array("probability")[1].alias("purchase_probability"),
        (F.current_timestamp() if run_ts is None else run_ts).alias("prediction_timestamp"),
    )


def score_day(
    model: PipelineModel, features: DataFrame, day: dt.date | str, run_ts: Column | None = None
) -> DataFrame:
    return score(model, on_day(features, "prediction_date", day), run_ts)


def session_stages(
    categories: Sequence[str] = SESSION_CATEGORIES, numbers: Sequence[str] = SESSION_NUMBERS
) -> list:
    """Index categories, assemble, scale; unseen values are kept."""
    indexed = [f"{name}_indexed" for name in categories]
    return [
        *[StringIndexer(inputCol=c, outputCol=i, handleInvalid="keep") for c, i in zip(categories, indexed)],
        VectorAssembler(inputCols=[*numbers, *indexed], outputCol="raw", handleInvalid="keep"),
        StandardScaler(inputCol="raw", outputCol="features", withStd=True, withMean=False),
    ]


def session_inputs(features: DataFrame) -> DataFrame:
    return features.select(
        "session_id",
        *SESSION_CATEGORIES,
        *[F.coalesce(as_double(name), F.lit(0.0)).alias(name) for name in SESSION_NUMBERS],
        flag(F.col("label")).alias("label"),
    )


def session_classifiers(seed: int = 42) -> dict[str, Any]:
    return {
        "logistic_regression": LogisticRegression(maxIter=100, regParam=0.01, elasticNetParam=0.5),
        "random_forest": RandomForestClassifier(
            numTrees=100, maxDepth=10, minInstancesPerNode=5, seed=seed
        ),
        "gradient_boosted_trees": GBTClassifier(maxIter=50, maxDepth=5, stepSize=0.1, seed=seed),
    }


def evaluate(scored: DataFrame) -> dict[str, float]:
    """Area under ROC, accuracy and F1 of scored rows, scored once for all."""
    kept = scored.select("label", "prediction", "rawPrediction", "probability")
    kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {
            "auc": BinaryClassificationEvaluator(metricName="areaUnderROC").evaluate(kept),
            "accuracy": MulticlassClassificationEvaluator(metricName="accuracy").evaluate(kept),
            "f1": MulticlassClassificationEvaluator(metricName="f1").evaluate(kept),
        }
    finally:
        kept.unpersist()


def class_metrics(scored: DataFrame) -> DataFrame:
    """Precision, recall and F1 of each class, from the confusion counts."""
    cells = confusion(scored)
    hits = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(0))
    actual = cells.groupBy("label").agg(hits.alias("hits"), F.sum("rows").alias("actual"))
    predicted = cells.groupBy(F.col("prediction").alias("label")).agg(F.sum("rows").alias("predicted"))
    joined = actual.join(predicted, "label", "left").withColumns(
        {
            "precision": F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0)),
            "recall": F.coalesce(F.try_divide("hits", "actual"), F.lit(0.0)),
        }
    )
    both = F.col("precision") + F.col("recall")
    return joined.select(
        "label", "precision", "recall",
        F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0).alias("f1"),
    )


def confusion(scored: DataFrame) -> DataFrame:
    return scored.groupBy(
        F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("rows"))


def compare_classifiers(
    train: DataFrame, test: DataFrame, classifiers: dict[str, Any] | None = None
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fitted models by name and one row of metrics per model.

    The feature preparation is fitted once; its output, label and features
    alone, is kept for all classifiers.
    """
    classifiers = classifiers or session_classifiers()
    preparation = Pipeline(stages=session_stages()).fit(train)
    train, test = (
        preparation.transform(part).select("label", "features").persist(StorageLevel.MEMORY_AND_DISK)
        for part in (train, test)
    )
    models, lines = {}, []
    for name, classifier in classifiers.items():
        fitted = classifier.fit(train)
        models[name] = PipelineModel(stages=[*preparation.stages, fitted])
        lines.append((name, *evaluate(fitted.transform(test)).values()))
    train.unpersist()
    test.unpersist()
    spark = train.sparkSession
    return models, spark.createDataFrame(lines, "model string, auc double, accuracy double, f1 double")


def best_model(metrics: DataFrame) -> DataFrame:
    """The row with the highest area under ROC."""
    return metrics.orderBy(F.desc("auc"), "model").limit(1)


def feature_importance(model: PipelineModel, limit: int | None = 20) -> DataFrame:
    """Inputs of a tree model by importance; one row per input."""
    spark = SparkSession.getActiveSession()
    assembler = next(stage for stage in model.stages if isinstance(stage, VectorAssembler))
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(assembler.getInputCols(), weights)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    ranked = table.orderBy(F.desc("importance"), "feature")
    return ranked if limit is None else ranked.limit(limit)


def with_class_weights(train: DataFrame, column: str = "class_weight") -> DataFrame:
    """Weights that give both classes the same total, for ``weightCol``."""
    share = train.agg(F.avg(F.col("label").cast("double"))).scalar()
    return train.withColumn(column, F.when(F.col("label") == 1, 0.5 / share).otherwise(0.5 / (1 - share)))


def tuned(
    pipeline: Pipeline, grid: list, train: DataFrame, folds: int | None = 3, seed: int = 42, at_once: int = 2
):
    """Best pipeline over a parameter grid, by area under ROC.

    ``folds=None`` uses one train/validation split instead.  ``at_once`` models
    are fitted side by side.
    """
    metric = BinaryClassificationEvaluator(metricName="areaUnderROC")
    common = {"estimator": pipeline, "estimatorParamMaps": grid, "evaluator": metric, "seed": seed, "parallelism": at_once}
    search = TrainValidationSplit(**common) if folds is None else CrossValidator(numFolds=folds, **common)
    return search.fit(train)


def score_rows(df: DataFrame, model: Any, inputs: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Scores with any object offering ``predict`` and ``predict_proba``.

    The caller hands over the model itself; nothing is unpickled from a path.
    Rows are scored where they are, one Arrow batch at a time.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    inputs, keys = list(inputs), list(keys)

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            matrix = frame[inputs].to_numpy(dtype=float)
            out = frame[keys].copy()
            out["will_purchase_tomorrow"] = shared.value.predict(matrix).astype("int32")
            out["purchase_probability"] = shared.value.predict_proba(matrix)[:, 1].astype(float)
            yield out

    rows = df.select(*keys, *[F.coalesce(as_double(name), F.lit(0.0)).alias(name) for name in inputs])
    schema = T.StructType(
        [
            *rows.select(*keys).schema.fields,
            T.StructField("will_purchase_tomorrow", T.IntegerType()),
            T.StructField("purchase_probability", T.DoubleType()),
        ]
    )
    return rows.mapInPandas(batches, schema)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_model_metadata(
    spark: SparkSession, path: str, kind: str, metrics: dict[str, float], trained_on: dt.date,
    inputs: Sequence[str], top_inputs: Sequence[str],
) -> None:
    """One JSON row describing a saved model."""
    row = (
        kind, metrics["auc"], metrics["accuracy"], metrics["f1"], str(trained_on),
        len(inputs), list(inputs), list(top_inputs)[:10],
    )
    schema = (
        "model_type string, auc double, accuracy double, f1_score double, training_date string,"
        " num_features int, feature_names array<string>, top_10_features array<string>"
    )
    spark.createDataFrame([row], schema).write.mode("overwrite").json(path)
