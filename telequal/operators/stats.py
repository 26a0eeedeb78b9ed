"""Fitted statistics: scaling, correlations, profiles, histograms, shares."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telequal.operators.ordered import exact_quantiles, fitted_row, number


def fit_standardizer(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with a (mean, scale) struct per column; population deviation, 1 where it is 0."""

    def scale(c: str) -> Column:
        std = F.stddev_pop(c)
        return F.when(std > 0, std).otherwise(F.lit(1.0))

    return df.agg(*[F.struct(F.avg(c).alias("mean"), scale(c).alias("scale")).alias(c) for c in cols])


def standardize(df: DataFrame, fitted: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    s = fitted_row(fitted)
    return df.withColumns({f"{c}{suffix}": (F.col(c) - number(s[c]["mean"])) / number(s[c]["scale"]) for c in cols})


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in cols])


def minmax_norm(df: DataFrame, fitted: DataFrame, cols: Sequence[str], suffix: str = "_norm") -> DataFrame:
    s = fitted_row(fitted)
    return df.withColumns(
        {
            f"{c}{suffix}": (F.col(c) - number(s[c]["lo"]))
            / (number(s[c]["hi"]) - number(s[c]["lo"]) + F.lit(1e-9))
            for c in cols
        }
    )


def corr_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """(column, r) by falling |r|, all coefficients in one pass."""
    items = [F.struct(F.lit(c).alias("column"), F.corr(c, target).alias("r")) for c in cols]
    return (
        df.agg(F.array(*items).alias("rs"))
        .select(F.inline("rs"))
        .orderBy(F.abs("r").desc_nulls_last(), "column")
    )


def corr_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.85) -> DataFrame:
    """Feature pairs whose |r| exceeds ``threshold``; the pairs are of columns, not of rows."""
    items = [
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.abs(F.corr(a, b)).alias("r"))
        for a, b in combinations(cols, 2)
    ]
    return df.agg(F.array(*items).alias("rs")).select(F.inline("rs")).where(F.col("r") > threshold)


def percentile_label(df: DataFrame, score: str, share: float = 0.74, out: str = "label") -> DataFrame:
    """1 for scores above the ``share`` percentile."""
    cut = fitted_row(exact_quantiles(df, [score], {"cut": share}))["cut"]
    return df.withColumn(out, F.when(F.col(score) > number(cut), 1).otherwise(0))


def label_histogram(df: DataFrame, col: str, label: str, bins: int = 60) -> DataFrame:
    """(label, bin, n) over equal-width bins of the whole range; a constant column is all in bin 0."""
    s = fitted_row(df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")))
    step = F.floor(F.try_divide(F.col(col) - number(s["lo"]), number(s["hi"]) - number(s["lo"])) * bins)
    bin_no = F.least(F.coalesce(step, F.lit(0)), F.lit(bins - 1)).cast("int")
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(label).alias("label"), bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def series_profile(df: DataFrame, series: str, col: str) -> DataFrame:
    return df.groupBy(series).agg(
        F.count(col).alias("n"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std")
    )


def load_summary(df: DataFrame, name: str, label: Column) -> DataFrame:
    """One row per data set: table, n_rows, n_columns, label_rate."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(label.cast("double")).alias("label_rate")).select(
        F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).alias("n_columns"), "label_rate"
    )


def importance_share(df: DataFrame, value: str, out: str = "pct_of_max") -> DataFrame:
    """Percent of the largest value; null if that is 0."""
    top = fitted_row(df.agg(F.max(value).alias("top")))["top"]
    return df.withColumn(out, F.try_divide(F.col(value), number(top)) * 100)


def topk(df: DataFrame, value: str, k: int, *ties: str) -> DataFrame:
    """The ``k`` rows with the largest value, missing values last, ties in a fixed order."""
    return df.orderBy(F.col(value).desc_nulls_last(), *ties).limit(k)


def risk_kpis(df: DataFrame, prob: str, risk: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(risk) == "High").alias("high"),
        F.count_if(F.col(risk) == "Medium").alias("medium"),
        F.avg(prob).alias("mean_probability"),
    )
