"""Duplicate removal and its report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The last row per key under a total order.

    ``row_number = 1`` is limited within each map task before the shuffle, so a key with very many
    copies sends one row per task.
    """
    latest = [(F.col(o) if isinstance(o, str) else o).desc() for o in order]
    w = Window.partitionBy(*keys).orderBy(*latest)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedup_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: exact_rows, key_duplicates, rows_after (copies are counted map-side first)."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    per_key = copies.groupBy(*keys).agg(
        F.sum("_copies").alias("_rows"), F.count(F.lit(1)).alias("_distinct")
    )
    return per_key.agg(
        F.coalesce(F.sum(F.col("_rows") - F.col("_distinct")), F.lit(0)).alias("exact_rows"),
        F.coalesce(F.sum(F.col("_distinct") - 1), F.lit(0)).alias("key_duplicates"),
        F.count(F.lit(1)).alias("rows_after"),
    )
