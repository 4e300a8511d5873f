"""Quality of model predictions against labels, per window and model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.exprs import percent
from vigil.operators.profile import window_start

PROBLEMS = ("classification", "regression")


def confusion(
    log: DataFrame,
    ts: str = "ts",
    model: str = "model_id",
    prediction: str = "prediction",
    label: str = "label",
    granularity: str = "1 day",
) -> DataFrame:
    """Labelled predictions counted per (window, model, prediction, label)."""
    return (
        log.filter(F.col(label).isNotNull())
        .groupBy(
            window_start(ts, granularity).alias("window_start"),
            F.col(model).alias("model_id"),
            F.col(prediction).alias("prediction"),
            F.col(label).alias("label"),
        )
        .agg(F.count("*").alias("records"))
    )


def classification(
    log: DataFrame,
    ts: str = "ts",
    model: str = "model_id",
    prediction: str = "prediction",
    label: str = "label",
    granularity: str = "1 day",
    positive: Column | int | str = 1,
) -> DataFrame:
    """Accuracy, and precision, recall and F1 of the positive class, in percent."""
    yes = positive if isinstance(positive, Column) else F.lit(positive)
    said, is_true = F.col(prediction) == yes, F.col(label) == yes
    labelled = F.col(label).isNotNull()
    counts = log.groupBy(
        window_start(ts, granularity).alias("window_start"), F.col(model).alias("model_id")
    ).agg(
        F.count("*").alias("predictions"),
        F.count_if(labelled).alias("labelled"),
        F.count_if(F.col(prediction) == F.col(label)).alias("correct"),
        F.count_if(said & is_true).alias("true_positives"),
        F.count_if(said & ~is_true).alias("false_positives"),
        F.count_if(~said & is_true).alias("false_negatives"),
        F.count_if(~said & ~is_true).alias("true_negatives"),
    )
    tp, fp, fn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives"))
    return counts.withColumns(
        {
            "accuracy": percent(F.col("correct"), F.col("labelled")),
            "precision": percent(tp, tp + fp),
            "recall": percent(tp, tp + fn),
            "f1": percent(tp * 2, tp * 2 + fp + fn),
        }
    )


def regression(
    log: DataFrame,
    ts: str = "ts",
    model: str = "model_id",
    prediction: str = "prediction",
    label: str = "label",
    granularity: str = "1 day",
) -> DataFrame:
    """MAE, MSE, RMSE, R² and MAPE."""
    truth = F.col(label).cast("double")
    error = F.col(prediction).cast("double") - truth
    sums = (
        log.filter(F.col(prediction).isNotNull() & F.col(label).isNotNull())
        .groupBy(
            window_start(ts, granularity).alias("window_start"), F.col(model).alias("model_id")
        )
        .agg(
            F.count("*").alias("labelled"),
            F.avg(F.abs(error)).alias("mae"),
            F.avg(error * error).alias("mse"),
            F.var_pop(truth).alias("_variance"),
            F.avg(F.try_divide(F.abs(error), F.abs(truth))).alias("_relative"),
        )
    )
    return sums.select(
        "window_start",
        "model_id",
        "labelled",
        "mae",
        "mse",
        F.sqrt("mse").alias("rmse"),
        (F.lit(1.0) - F.try_divide("mse", "_variance")).alias("r2"),
        (F.col("_relative") * 100).alias("mape"),
    )


def monitor(log: DataFrame, problem: str, **columns) -> DataFrame:
    """Prediction quality of an inference log of either problem type."""
    if problem.lower() not in PROBLEMS:
        raise ValueError(f"problem must be one of {PROBLEMS}, not {problem!r}")
    run = classification if problem.lower() == "classification" else regression
    return run(log, **columns)
