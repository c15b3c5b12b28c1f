"""Model scores as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import round_even


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (actual, predicted) pair."""
    return df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("rows"))


def class_report(df: DataFrame, label: str, prediction: str, classes: Sequence[str]) -> DataFrame:
    """Precision, recall, F1 and support; a class without rows gets zeros.

    One pass with a few counters per class.
    """
    actual, predicted = F.col(label), F.col(prediction)
    counts = df.agg(*[
        F.struct(
            F.lit(c).alias("class"),
            F.count_if((actual == c) & (predicted == c)).alias("hit"),
            F.count_if(predicted == c).alias("called"),
            F.count_if(actual == c).alias("support"),
        ).alias(f"_k{i}") for i, c in enumerate(classes)
    ]).select(F.inline(F.array(*[F.col(f"_k{i}") for i in range(len(classes))])))
    share = lambda part, whole: F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))
    return counts.select(
        "class",
        share("hit", "called").alias("precision"),
        share("hit", "support").alias("recall"),
        F.coalesce(F.try_divide(F.lit(2.0) * F.col("hit"), F.col("called") + F.col("support")), F.lit(0.0)).alias("f1"),
        "support",
    )


def class_scores(df: DataFrame, label: str, prediction: str, classes: Sequence[str], digits: int = 4) -> DataFrame:
    """F1 weighted by support, and accuracy; one row."""
    report = class_report(df, label, prediction, classes)
    total = F.sum("support")
    return report.agg(
        round_even(F.coalesce(F.try_divide(F.sum(F.col("f1") * F.col("support")), total), F.lit(0.0)), digits)
        .alias("f1_weighted"),
        round_even(F.coalesce(F.try_divide(F.sum(F.col("recall") * F.col("support")), total), F.lit(0.0)), digits)
        .alias("accuracy"),
    )


def regression_scores(df: DataFrame, actual: str, predicted: str, digits: int = 4) -> DataFrame:
    """RMSE, MAE and R2 in one pass; R2 is missing where the actual values do not vary."""
    gap = F.col(actual) - F.col(predicted)
    return df.agg(
        round_even(F.sqrt(F.avg(gap * gap)), digits).alias("RMSE"),
        round_even(F.avg(F.abs(gap)), digits).alias("MAE"),
        round_even(F.when(F.min(actual) < F.max(actual),
                          F.lit(1.0) - F.try_divide(F.avg(gap * gap), F.var_pop(actual))), digits).alias("R2"),
    )


def best_model(scores: dict[str, dict[str, float]], metric: str, largest: bool) -> str:
    """Name of the model with the best score; the first one wins a tie."""
    pick = max if largest else min
    return pick(scores, key=lambda name: scores[name][metric])


def comparison(spark: SparkSession, scores: dict[str, dict[str, float]]) -> DataFrame:
    """One row per model."""
    metrics = list(next(iter(scores.values())))
    rows = [(name, *[float(found[m]) for m in metrics]) for name, found in scores.items()]
    return spark.createDataFrame(rows, "model string, " + ", ".join(f"`{m}` double" for m in metrics))


def value_range(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Common range of actual and predicted values."""
    return df.agg(
        F.least(F.min(actual), F.min(predicted)).alias("low"),
        F.greatest(F.max(actual), F.max(predicted)).alias("high"),
    )
