"""Rolling, baseline and breach features of a panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from telequal.operators.panel import Layout, join_entity_stats, running_sum, windowed
from telequal.schemas import BASELINE_MIN_ROWS, BASELINE_ROWS, ROLLING_ROWS, SIGMAS


def _frame(w: WindowSpec, rows: int) -> WindowSpec:
    return w.rowsBetween(1 - rows, 0)


def rolling_std(
    df: DataFrame, layout: Layout, col: str, out: str, rows: int = ROLLING_ROWS, strict: bool = False
) -> DataFrame:
    """Sample deviation of the last ``rows`` rows, 0 where undefined.

    ``strict`` also gives 0 until the frame is full.
    """

    def build(src: DataFrame, w: WindowSpec) -> DataFrame:
        f = _frame(w, rows)
        value = F.stddev_samp(col).over(f)
        if strict:
            value = F.when(F.count(col).over(f) == rows, value)
        return src.withColumn(out, F.coalesce(value, F.lit(0.0)))

    return windowed(df, layout, rows - 1, build)


def rolling_rate(
    df: DataFrame, layout: Layout, col: str, out: str, rows: int = ROLLING_ROWS, strict: bool = False
) -> DataFrame:
    """Mean of the last ``rows`` row-to-row changes, 0 where undefined."""

    def build(src: DataFrame, w: WindowSpec) -> DataFrame:
        f = _frame(w, rows)
        step = src.withColumn("_step", F.col(col) - F.lag(col).over(w))
        value = F.avg("_step").over(f)
        if strict:
            value = F.when(F.count("_step").over(f) == rows, value)
        return step.withColumn(out, F.coalesce(value, F.lit(0.0))).drop("_step")

    return windowed(df, layout, rows, build)


def rolling_baseline(
    df: DataFrame,
    layout: Layout,
    col: str,
    mean: str = "base_mean",
    std: str = "base_std",
    rows: int = BASELINE_ROWS,
    least: int = BASELINE_MIN_ROWS,
) -> DataFrame:
    """Trailing mean and deviation; with too little history the row's own value and 1."""

    def build(src: DataFrame, w: WindowSpec) -> DataFrame:
        f = _frame(w, rows)
        enough = F.count(col).over(f) >= least
        return src.withColumns(
            {
                mean: F.coalesce(F.when(enough, F.avg(col).over(f)), F.col(col)),
                std: F.coalesce(F.when(enough, F.stddev_samp(col).over(f)), F.lit(1.0)),
            }
        )

    return windowed(df, layout, rows - 1, build)


def rolling_baseline_seriesfill(
    df: DataFrame,
    layout: Layout,
    col: str,
    mean: str = "base_mean",
    std: str = "base_std",
    rows: int = BASELINE_ROWS,
    least: int = BASELINE_MIN_ROWS,
) -> DataFrame:
    """As :func:`rolling_baseline`, but short history takes the whole series' mean and deviation."""

    def build(src: DataFrame, w: WindowSpec) -> DataFrame:
        f = _frame(w, rows)
        enough = F.count(col).over(f) >= least
        return src.withColumns(
            {mean: F.when(enough, F.avg(col).over(f)), std: F.when(enough, F.stddev_samp(col).over(f))}
        )

    series = df.groupBy(layout.entity).agg(F.avg(col).alias("_all_mean"), F.stddev_samp(col).alias("_all_std"))
    joined = join_entity_stats(windowed(df, layout, rows - 1, build), series, layout)
    return joined.withColumns(
        {mean: F.coalesce(F.col(mean), F.col("_all_mean")), std: F.coalesce(F.col(std), F.col("_all_std"))}
    ).select(*df.columns, mean, std)


def lower_bound(mean: str = "base_mean", std: str = "base_std", sigmas: float | Column = SIGMAS) -> Column:
    return F.col(mean) - (sigmas if isinstance(sigmas, Column) else F.lit(float(sigmas))) * F.col(std)


def deviation_sigmas(col: str, mean: str = "base_mean", std: str = "base_std") -> Column:
    """How many deviations the value lies below its baseline."""
    return (F.col(mean) - F.col(col)) / (F.col(std) + F.lit(1e-6))


def sigma_breach(
    df: DataFrame, col: str, mean: str = "base_mean", std: str = "base_std", sigmas: float | Column = SIGMAS
) -> DataFrame:
    """Add lower_bound, deviation_sigmas and breach (1 when the value is below the bound); ``sigmas`` may be a column."""
    return df.withColumns(
        {
            "lower_bound": lower_bound(mean, std, sigmas),
            "deviation_sigmas": deviation_sigmas(col, mean, std),
            "breach": F.when(F.col(col) < lower_bound(mean, std, sigmas), 1).otherwise(0),
        }
    )


def sigma_state(
    col: str, mean: str = "base_mean", std: str = "base_std", sigmas: float = SIGMAS, jump: float = 15.0
) -> Column:
    """breach below the band; suspicious above the band by more than ``jump``; else normal."""
    c, m, s = F.col(col), F.col(mean), F.lit(float(sigmas)) * F.col(std)
    return (
        F.when(c < m - s, "breach").when((c > m + s) & (c - m > jump), "suspicious").otherwise("normal")
    )


def running_risk(
    df: DataFrame,
    layout: Layout,
    breach: Column,
    severe: Column,
    start: int = 12,
    severe_step: int = 18,
    step: int = 9,
    cap: int = 99,
) -> DataFrame:
    """Running breach count and risk that grows with every breach, up to ``cap``."""
    uplift = F.when(breach & severe, severe_step).when(breach, step).otherwise(0)
    sums = {"breach_count": F.when(breach, 1).otherwise(0), "_uplift": uplift}
    out = running_sum(df, layout, sums)
    return out.withColumn("risk", F.least(F.lit(cap), F.lit(start) + F.col("_uplift"))).drop("_uplift")
