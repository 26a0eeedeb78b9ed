"""Readers: date-partitioned and flat parquet, metrics JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telequal.session import broadcast_if_small

# Above this many values an IN list becomes a semi join.
IN_LIST_LIMIT = 1_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def scan(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    since: Column | None = None,
    ts: str = "timestamp",
    date_column: str = "date",
) -> DataFrame:
    """Read a parquet data set; only the asked columns reach the scan.

    ``since`` filters on the timestamp and, where the data is partitioned by date, on the date
    too, so that older folders are never listed or opened.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if since is not None:
        if date_column in df.columns:
            df = df.where(F.col(date_column) >= F.to_date(since))
        df = df.where(F.col(ts) >= since)
    return df.select(*columns) if columns else df


def only_keys(df: DataFrame, key: str, values: Sequence) -> DataFrame:
    """Rows whose key is listed: pushed into the scan, or a semi join for a long list."""
    if len(values) <= IN_LIST_LIMIT:
        return df.where(F.col(key).isin(list(values)))
    ids = df.sparkSession.createDataFrame([(v,) for v in values], df.select(key).schema)
    return df.join(broadcast_if_small(ids), key, "left_semi")


METRIC_FIELDS = ["roc_auc", "avg_prec", "precision", "recall", "f1"]
METRICS_SCHEMA = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("threshold", T.StringType())]
    + [T.StructField(m, T.DoubleType()) for m in METRIC_FIELDS]
    + [T.StructField("evaluation", T.StructType([T.StructField(m, T.DoubleType()) for m in METRIC_FIELDS]))]
)


def flatten_metrics(df: DataFrame) -> DataFrame:
    """One flat layout from metrics kept at the top or under ``evaluation``; missing ones become 0.

    The threshold may be a number or an object with a ``value``.
    """
    number = F.coalesce(
        F.get_json_object("threshold", "$.value").try_cast("double"), F.col("threshold").try_cast("double")
    )
    return df.select(
        "name",
        number.alias("threshold"),
        *[F.coalesce(F.col(m), F.col(f"evaluation.{m}"), F.lit(0.0)).alias(m) for m in METRIC_FIELDS],
    )


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return flatten_metrics(spark.read.schema(METRICS_SCHEMA).json(path))


def parse_metrics(df: DataFrame, column: str) -> DataFrame:
    """As :func:`read_metrics` for JSON text held in a column."""
    return flatten_metrics(df.select(F.from_json(column, METRICS_SCHEMA).alias("m")).select("m.*"))
