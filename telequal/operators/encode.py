"""Category codes: fixed maps, sorted label codes and their application to new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telequal.session import broadcast_if_small


def map_encode(col: str, codes: dict[str, int], unknown: int = -1) -> Column:
    pairs = [F.lit(x) for kv in codes.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[F.col(col)], F.lit(unknown))


def fit_label_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, code): codes number the sorted distinct values from 0.

    The window runs over the distinct values of a category, never over rows.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    values = long.where("value is not null").distinct()
    return values.withColumn(
        "code", (F.row_number().over(Window.partitionBy("column").orderBy("value")) - 1).cast("int")
    )


def apply_label_codes(
    df: DataFrame, codes: DataFrame, cols: Sequence[str], unseen: int = 0, suffix: str = "_code"
) -> DataFrame:
    """Add ``<col><suffix>``; a value the fit has not seen gets ``unseen``."""
    small = broadcast_if_small(codes)
    out = df
    for c in cols:
        one = small.where(F.col("column") == c).select(
            F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_k_{c}")
        )
        out = (
            out.join(one, F.col(c).cast("string") == F.col(f"_v_{c}"), "left")
            .withColumn(f"{c}{suffix}", F.coalesce(F.col(f"_k_{c}"), F.lit(unseen)))
            .drop(f"_v_{c}", f"_k_{c}")
        )
    return out
