"""Robust capping: quartiles of the normal rows only, applied to every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telequal.operators.ordered import approx_quantiles, exact_quantiles, per_column_struct
from telequal.operators.quality import clip_to

QUARTILES = {"q1": 0.25, "q3": 0.75}


def iqr_bounds(
    df: DataFrame, cols: Sequence[str], label: str, width: float = 3.0, exact: bool = True
) -> DataFrame:
    """(column, q1, q3, lower, upper) from rows whose label is 0."""
    normal = df.where(F.col(label) == 0)
    found = exact_quantiles(normal, cols, QUARTILES) if exact else approx_quantiles(normal, cols, QUARTILES)
    spread = F.col("q3") - F.col("q1")
    return found.select(
        "column",
        "q1",
        "q3",
        (F.col("q1") - width * spread).alias("lower"),
        (F.col("q3") + width * spread).alias("upper"),
    )


def iqr_cap(df: DataFrame, bounds: DataFrame, cols: Sequence[str]) -> DataFrame:
    return clip_to(df, per_column_struct(bounds, cols, ["lower", "upper"]), cols)


def cap_summary(df: DataFrame, bounds: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, lower, upper, n_capped), counted in one pass over ``df``."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    return (
        long.join(F.broadcast(bounds), "column")
        .groupBy("column", "lower", "upper")
        .agg(F.count_if((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))).alias("n_capped"))
    )
