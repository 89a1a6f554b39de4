"""Evaluation of scored rows: ``model, label, score``.

Counts are exact at any size.  Rows are first added up per model and score, so
what is ordered is the different scores, and many models share each pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scalars import flag
from cartwheel.operators.ranking import positions, running_totals
from cartwheel.session import staged

PAIR = "decimal(38,0)"


def score_counts(scored: DataFrame) -> DataFrame:
    """Rows of both classes per model and score; unknown labels and scores
    are left out."""
    return scored.where("label IS NOT NULL AND score IS NOT NULL").groupBy("model", "score").agg(
        F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives")
    )


def _with_totals(scored: DataFrame) -> DataFrame:
    """Per model and score also what lies below it and in all.

    The running totals go over all models in one order; taking off the total
    of the models before leaves a model's own.
    """
    counts = score_counts(scored).withColumn("order", F.struct("model", "score"))
    running = staged(running_totals(counts, "order", ["positives", "negatives"]).drop("order"), "running")
    whole = running.groupBy("model").agg(
        F.sum("positives").alias("all_positives"), F.sum("negatives").alias("all_negatives"),
        F.min("positives_before").alias("other_positives"), F.min("negatives_before").alias("other_negatives"),
    )
    return running.join(whole, "model").select(
        "model", "score", "positives", "negatives", "all_positives", "all_negatives",
        (F.col("positives_before") - F.col("other_positives")).alias("positives_below"),
        (F.col("negatives_before") - F.col("other_negatives")).alias("negatives_below"),
    )


def auc(scored: DataFrame) -> DataFrame:
    """Area under ROC of each model: the chance that a positive row scores
    above a negative one, a tie counting half.  NULL without both classes."""
    pairs = F.col("positives").cast(PAIR) * (2 * F.col("negatives_below") + F.col("negatives")).cast("decimal(20,0)")
    sums = _with_totals(scored).groupBy("model").agg(
        F.sum(pairs).cast("double").alias("wins"), F.max("all_positives").alias("positives"), F.max("all_negatives").alias("negatives")
    )
    all_pairs = 2 * F.col("positives").cast("double") * F.col("negatives").cast("double")
    return sums.select("model", "positives", "negatives", F.try_divide("wins", all_pairs).alias("auc"))


def threshold_sweep(scored: DataFrame) -> DataFrame:
    """Counts and rates of "positive from this score up" for every score."""
    hits = F.col("all_positives") - F.col("positives_below")
    alarms = F.col("all_negatives") - F.col("negatives_below")
    rows = _with_totals(scored).select("model", F.col("score").alias("threshold"), hits.alias("hits"), alarms.alias("false_alarms"), "all_positives")
    both = F.col("hits") + F.col("false_alarms") + F.col("all_positives")
    return rows.select(
        "model", "threshold", "hits", "false_alarms",
        F.try_divide(F.col("hits").cast("double"), (F.col("hits") + F.col("false_alarms")).cast("double")).alias("precision"),
        F.try_divide(F.col("hits").cast("double"), F.col("all_positives").cast("double")).alias("recall"),
        F.try_divide(2 * F.col("hits").cast("double"), both.cast("double")).alias("f1"),
    )


def best_threshold(scored: DataFrame) -> DataFrame:
    """The score of each model with the highest F1, the least of several."""
    best = F.max(F.struct("f1", (-F.col("threshold")).alias("turned"), "hits", "false_alarms")).alias("best")
    return threshold_sweep(scored).groupBy("model").agg(best).select(
        "model", (-F.col("best.turned")).alias("threshold"), "best.hits", "best.false_alarms", "best.f1"
    )


def confusion_counts(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows per model, label and predicted class."""
    return scored.where("label IS NOT NULL AND score IS NOT NULL").groupBy(
        "model", F.col("label").cast("int").alias("label"), flag(F.col("score") >= threshold).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("rows"))


def model_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """AUC, accuracy and F1 of the positive class, one row a model."""
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(0))
    hits = F.sum(F.when((F.col("label") == 1) & (F.col("prediction") == 1), F.col("rows")).otherwise(0))
    named = F.sum(F.when(F.col("prediction") == 1, F.col("rows")).otherwise(0))
    actual = F.sum(F.when(F.col("label") == 1, F.col("rows")).otherwise(0))
    cells = confusion_counts(scored, threshold).groupBy("model").agg(
        F.try_divide(right.cast("double"), F.sum("rows").cast("double")).alias("accuracy"),
        F.try_divide(2 * hits.cast("double"), (named + actual).cast("double")).alias("f1"),
    )
    return auc(scored).select("model", "auc").join(cells, "model")


def permuted(rows: DataFrame, keys: Sequence[str], column: str, seed: int = 42) -> DataFrame:
    """Rows with the values of one column dealt anew.

    Every row has a place in the order of its keys and another in the order of
    a hash of them; the value at place i of one order goes to the row at place
    i of the other.  The hash decides, so the deal can be repeated anywhere.
    """
    text = F.concat_ws("|", F.lit(f"{seed}:{column}"), *[F.col(k).cast("string") for k in keys])
    numbered = positions(rows.withColumn("deal", F.md5(text)), ["deal", *keys], "dealt")
    taken = positions(rows.select(*keys, F.col(column).alias("other")), keys, "dealt").select("dealt", "other")
    return numbered.drop("deal", column).join(taken, "dealt").drop("dealt").withColumnRenamed("other", column).select(*rows.columns)


def permutation_importance(
    rows: DataFrame, keys: Sequence[str], inputs: Sequence[str], score: Callable[[], Column], label: str = "label", seed: int = 42
) -> DataFrame:
    """How much AUC a model loses when one input's values are dealt anew.

    ``score`` gives the model's score as a column of the inputs.  ``keys`` must
    tell the rows apart.  All inputs are judged in one evaluation.
    """
    rows = staged(rows.select(*keys, *inputs, F.col(label).alias("label")), "inputs")

    def scored(table: DataFrame, name: str) -> DataFrame:
        return table.select(F.lit(name).alias("model"), "label", score().alias("score"))

    all_ = scored(rows, "")
    for name in inputs:
        all_ = all_.unionByName(scored(permuted(rows, keys, name, seed), name))
    # A row per input, known to the driver by name.
    found = {r.model: r.auc for r in auc(all_).collect()}
    lines = [(name, found[""] - found[name]) for name in inputs if found.get("") is not None]
    ranked = rows.sparkSession.createDataFrame(lines, "feature string, importance double")
    return ranked.orderBy(F.desc("importance"), "feature")
