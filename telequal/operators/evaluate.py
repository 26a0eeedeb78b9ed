"""Classifier, forecast and drift metrics, exact at any row count.

Scores are first counted per distinct value (map-side combined), so a score shared by a third of
all rows is one row of the running sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telequal.operators.ordered import running_totals


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return F.lit(2.0) * p * r / (p + r + F.lit(1e-9))


def confusion_metrics(
    df: DataFrame, label: str, predicted: Column, keys: Sequence[str] = ()
) -> DataFrame:
    """tn, fp, fn, tp, precision, recall, f1; ratios are 0 where undefined.

    A row without a prediction counts as predicted negative, so a positive that was never scored lowers recall.
    """
    y = F.col(label) == 1
    predicted = F.coalesce(predicted, F.lit(False))
    counts = df.groupBy(*keys).agg(
        F.count_if(~predicted & ~y).alias("tn"),
        F.count_if(predicted & ~y).alias("fp"),
        F.count_if(~predicted & y).alias("fn"),
        F.count_if(predicted & y).alias("tp"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        *keys,
        "tn",
        "fp",
        "fn",
        "tp",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def score_counts(
    df: DataFrame, label: str, score: str, keys: Sequence[str] = (), n: int | None = None
) -> DataFrame:
    """Per distinct score: pos and neg counts, with their running sums and totals.

    A row without a score (null or NaN) ranks below all scores, so it is never among the predicted positives of
    a threshold but counts in the totals; rows without a label are left out.
    """
    number_of = F.coalesce(F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double")), F.lit(float("-inf")))
    src = df.where(F.col(label).isNotNull()).withColumn(score, number_of)
    per_score = src.groupBy(*keys, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    fit_on = src.select(F.col(score).cast("double").alias("score"))
    return running_totals(per_score, "score", ["pos", "neg"], keys, fit_on, n)


def roc_auc(
    df: DataFrame, label: str, score: str, keys: Sequence[str] = (), n: int | None = None
) -> DataFrame:
    """Area under the ROC curve per ``keys``; ties count one half."""
    below = F.col("cum_neg") - F.col("neg") / F.lit(2.0)
    won = F.col("pos").cast("double") * below
    pairs = F.max(F.col("total_pos").cast("double") * F.col("total_neg").cast("double"))
    return (
        score_counts(df, label, score, keys, n)
        .groupBy(*keys)
        .agg(
            F.max("total_pos").alias("n_pos"),
            F.max("total_neg").alias("n_neg"),
            F.when(pairs > 0, F.sum(won) / pairs).alias("auc"),
        )
    )


def pr_curve(
    df: DataFrame, label: str, score: str, keys: Sequence[str] = (), n: int | None = None
) -> DataFrame:
    """(threshold, tp, fp, precision, recall, f1) for every distinct score, predicting score >= threshold."""
    tp = F.col("total_pos") - F.col("cum_pos") + F.col("pos")
    fp = F.col("total_neg") - F.col("cum_neg") + F.col("neg")
    p, r = _ratio(F.col("tp"), F.col("tp") + F.col("fp")), _ratio(F.col("tp"), F.col("total_pos"))
    return (
        score_counts(df, label, score, keys, n)
        .withColumns({"tp": tp, "fp": fp})
        .select(
            *keys,
            F.col("score").alias("threshold"),
            "tp",
            "fp",
            "pos",
            "total_pos",
            p.alias("precision"),
            r.alias("recall"),
        )
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    )


def best_f1_threshold(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The curve point of largest F1; the lowest threshold on ties."""
    fields = ["threshold", "precision", "recall", "f1"]
    best = F.max(F.struct("f1", (-F.col("threshold")).alias("low"), F.struct(*fields).alias("point")))
    return curve.groupBy(*keys).agg(best.alias("best")).select(*keys, "best.point.*")


def average_precision(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sum of precision over the recall gained at each threshold."""
    gain = _ratio(F.col("pos"), F.col("total_pos")) * F.col("precision")
    return curve.groupBy(*keys).agg(F.sum(gain).alias("average_precision"))


def forecast_error(
    df: DataFrame, actual: str = "actual", forecast: str = "forecast", keys: Sequence[str] = ()
) -> DataFrame:
    """n, mae, rmse and mape (percent) over rows that have both values."""
    a, e = F.col(actual), F.col(actual) - F.col(forecast)
    return (
        df.where(e.isNotNull())
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.abs(e)).alias("mae"),
            F.sqrt(F.avg(e * e)).alias("rmse"),
            (F.avg(F.abs(e) / (F.abs(a) + F.lit(1e-6))) * 100).alias("mape"),
        )
    )


def ks_drift(
    df: DataFrame, cols: Sequence[str], second: Column, n: int | None = None
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per column between rows where ``second`` is false and true."""
    long = df.select(
        F.when(second, 1).otherwise(0).alias("_b"), *[F.col(c).cast("double").alias(c) for c in cols]
    ).unpivot(["_b"], list(cols), "column", "value")
    counts = (
        long.where("value is not null")
        .groupBy("column", "value")
        .agg(F.count_if(F.col("_b") == 0).alias("a"), F.count_if(F.col("_b") == 1).alias("b"))
    )
    gap = F.abs(
        F.col("cum_a") / F.nullif(F.col("total_a"), F.lit(0)) - F.col("cum_b") / F.nullif(F.col("total_b"), F.lit(0))
    )
    return (
        running_totals(counts, "value", ["a", "b"], ["column"], long.where("value is not null"), n)
        .groupBy("column")
        .agg(
            F.max("total_a").alias("n_first"), F.max("total_b").alias("n_second"), F.max(gap).alias("ks")
        )
    )
