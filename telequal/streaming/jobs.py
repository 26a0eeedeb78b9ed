"""Streaming forms of deduplication, hourly rollup and breach scoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from telequal.operators.features import sigma_breach
from telequal.schemas import SIGMAS


def event_time(stream: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need a timestamp with a zone; files may hold one without."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_dedup(stream: DataFrame, entity: str, ts: str, late: str = "2 hours") -> DataFrame:
    """One row per (entity, ts): the first to arrive.  State older than the watermark is dropped."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([entity, ts])


def stream_hourly_rollup(
    stream: DataFrame, entity: str, ts: str, value: str, late: str = "2 hours", slide: str | None = None
) -> DataFrame:
    """n, mean, min and max per entity and hour (tumbling, or sliding by ``slide``), final once the hour has passed."""
    hour = F.window(ts, "1 hour", slide) if slide else F.window(ts, "1 hour")
    return (
        stream.withWatermark(ts, late)
        .groupBy(hour.alias("_w"), F.col(entity))
        .agg(
            F.count(value).alias("n"),
            F.avg(value).alias("mean"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
        )
        .select(entity, F.col("_w.start").alias("hour"), "n", "mean", "low", "high")
    )


def latest_baseline(history: DataFrame, entity: str, order: list[str]) -> DataFrame:
    """(entity, base_mean, base_std) of the newest scored row per entity, combined map-side."""
    newest = F.max_by(F.struct("base_mean", "base_std"), F.struct(*order))
    return history.groupBy(entity).agg(newest.alias("b")).select(entity, "b.base_mean", "b.base_std")


def stream_breaches(stream: DataFrame, baseline: DataFrame, entity: str, col: str, sigmas: float = SIGMAS) -> DataFrame:
    """Score arriving readings against each entity's latest baseline (stream-static join)."""
    return sigma_breach(stream.join(baseline, entity), col, sigmas=sigmas)


def start_scoring(
    stream: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> DataStreamWriter:
    """Writer that applies a batch scoring function to every micro-batch.

    Each batch overwrites its own folder, so a retried batch leaves one copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    )
