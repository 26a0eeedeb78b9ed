"""Signals carried from one entity type to another: co-occurrence, counts and recency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telequal.functions.calendar import days_between, hour_floor
from telequal.schemas import HORIZON_DAYS
from telequal.session import broadcast_if_small


def cross_signal_flag(
    df: DataFrame, events: DataFrame, key: str, ts: str, out: str, event_key: str | None = None
) -> DataFrame:
    """1 where the same key has an event in the row's hour.

    Events are reduced to distinct (key, hour) first, so the join never multiplies rows; while those are
    few the rows are not shuffled, beyond that adaptive execution splits a hot (key, hour).
    """
    hours = broadcast_if_small(
        events.select(
            F.col(event_key or key).alias("_k"), hour_floor(ts).alias("_h"), F.lit(1).alias("_seen")
        ).distinct()
    )
    return (
        df.withColumn("_hour", hour_floor(ts))
        .join(hours, (F.col(key) == F.col("_k")) & (F.col("_hour") == F.col("_h")), "left")
        .withColumn(out, F.coalesce(F.col("_seen"), F.lit(0)))
        .drop("_hour", "_k", "_h", "_seen")
    )


def enrich_left_default(df: DataFrame, facts: DataFrame, key: str, defaults: dict[str, int | float]) -> DataFrame:
    """Left join per-key aggregates; keys without facts get the defaults."""
    return df.join(facts, key, "left").fillna(defaults)


def dim_lookup(df: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Attach a dimension, broadcast only while it is measured to be small."""
    return df.join(broadcast_if_small(dim), key, how)


def trailing_event_count(
    events: DataFrame, key: str, ts: str, flag: str, cutoff: Column, out: str
) -> DataFrame:
    """Flag sum per key since ``cutoff`` (a scalar, so the scan can skip older files)."""
    return (
        events.where(F.col(ts) >= cutoff).groupBy(key).agg(F.sum(flag).cast("bigint").alias(out))
    )


def last_event(events: DataFrame, key: str, ts: str, flag: str, out: str) -> DataFrame:
    return events.where(F.col(flag) == 1).groupBy(key).agg(F.max(ts).alias(out))


def recency_days(
    keys: DataFrame,
    key: str,
    sources: list[DataFrame],
    until: Column,
    out: str = "days_since_last",
    fallback: int = HORIZON_DAYS,
) -> DataFrame:
    """Days from the latest event of any source to ``until``; ``fallback`` without events.

    Each source has the key and one timestamp column.
    """
    joined = keys
    names = []
    for i, src in enumerate(sources):
        (ts,) = [c for c in src.columns if c != key]
        names.append(f"_last{i}")
        joined = joined.join(src.withColumnRenamed(ts, f"_last{i}"), key, "left")
    latest = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    days = F.coalesce(days_between(until, latest), F.lit(fallback))
    return joined.withColumn(out, days.cast("bigint")).drop(*names)


def cooccurrence_rate(df: DataFrame, breach: str, flag: str) -> DataFrame:
    """One row: breaches, those with the other signal set, and their share."""
    both = F.count_if((F.col(breach) == 1) & (F.col(flag) == 1))
    n = F.count_if(F.col(breach) == 1)
    return df.agg(
        n.alias("n_breach"),
        both.alias("n_both"),
        F.when(n > 0, both / n).otherwise(F.lit(0.0)).alias("rate"),
    )
