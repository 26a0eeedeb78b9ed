"""Writers whose reruns leave one copy of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_by_date(df: DataFrame, path: str, ts: str = "timestamp", date_column: str = "date") -> None:
    """Hive-style date folders; a rerun replaces the dates it holds and no others.

    Rows are grouped by date; adaptive execution splits a very large day over many tasks and merges small ones.
    """
    (
        df.withColumn(date_column, F.to_date(ts))
        .hint("rebalance", F.col(date_column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(path)
    )


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """Reports and metrics are a handful of rows: one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def records_json(df: DataFrame, out: str = "record") -> DataFrame:
    """One JSON object per row, timestamps as text, missing values as null."""
    text: list[Column] = [
        F.col(f.name).cast("string").alias(f.name) if f.dataType.typeName().startswith("timestamp") else F.col(f.name)
        for f in df.schema
    ]
    return df.select(F.to_json(F.struct(*text), {"ignoreNullFields": "false"}).alias(out))
