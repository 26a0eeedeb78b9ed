"""Ordered work inside entities of any size.

Most entities fit one task, so a plain window over the entity is right.  An entity with
more than ``max_rows`` rows is *hot*: it is numbered by (time bucket offset + position in
bucket), cut into equal blocks, and each block gets the few preceding rows its frames need.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from telequal.operators.ordered import BUCKET, range_splits, with_bucket

MAX_ENTITY_ROWS = 2_000_000
BLOCK, HALO, POS = "_block", "_halo", "_pos"


@dataclass(frozen=True)
class Layout:
    """Measured shape of a panel; valid for any frame with no more rows per entity."""

    entity: str
    order: tuple[str, ...]
    hot: DataFrame | None
    splits: tuple[float, ...]
    max_rows: int

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows of ordinary entities, rows of hot entities)."""
        hot = F.broadcast(self.hot)
        return df.join(hot, self.entity, "left_anti"), df.join(hot, self.entity, "left_semi")

    def bucketed(self, hot_rows: DataFrame) -> DataFrame:
        at = hot_rows.withColumn("_at", F.unix_micros(F.col(self.order[0]).cast("timestamp")).cast("double"))
        return with_bucket(at, "_at", list(self.splits)).drop("_at")


def measure(
    df: DataFrame, entity: str, order: Sequence[str], max_rows: int = MAX_ENTITY_ROWS
) -> Layout:
    """Count rows per entity (map-side combined) and place time cuts for the hot ones.

    The first ``order`` column is a timestamp.  Hot entities number at most rows/max_rows.
    """
    hot_counts = (
        df.groupBy(entity).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > max_rows).collect()
    )
    if not hot_counts:
        return Layout(entity, tuple(order), None, (), max_rows)
    spark = df.sparkSession
    hot = spark.createDataFrame(
        [(r[entity],) for r in hot_counts], df.select(entity).schema
    )
    buckets = max(2, -(-sum(r["rows"] for r in hot_counts) // max_rows))
    times = df.join(F.broadcast(hot), entity, "left_semi").select(
        F.unix_micros(F.col(order[0]).cast("timestamp")).alias("_at")
    )
    return Layout(entity, tuple(order), hot, tuple(range_splits(times, "_at", buckets)), max_rows)


def numbered(df: DataFrame, layout: Layout) -> DataFrame:
    """0-based position of every row of the hot entities, without one task per entity."""
    src = layout.bucketed(df)
    before = Window.partitionBy(layout.entity).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        src.groupBy(layout.entity, BUCKET)
        .agg(F.count(F.lit(1)).alias("_t"))
        .select(layout.entity, BUCKET, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    )
    inside = Window.partitionBy(layout.entity, BUCKET).orderBy(*layout.order)
    return (
        src.join(offsets, [layout.entity, BUCKET])
        .withColumn(POS, F.col("_off") + F.row_number().over(inside) - 1)
        .drop("_off", BUCKET)
    )


def windowed(
    df: DataFrame,
    layout: Layout,
    lookback: int,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
) -> DataFrame:
    """Run ``build(frame, window)`` where no frame reaches more than ``lookback`` rows back."""
    if layout.hot is None:
        return build(df, Window.partitionBy(layout.entity).orderBy(*layout.order))
    size = max(layout.max_rows, lookback + 1)
    cold, hot = layout.split(df)
    own = F.floor(F.col(POS) / size)
    lent = F.when(F.col(POS) % size >= size - lookback, F.array(own, own + 1)).otherwise(F.array(own))
    blocks = numbered(hot, layout).select(
        *df.columns, own.alias("_own"), F.explode(lent).alias(BLOCK)
    )
    both = cold.withColumn(BLOCK, F.lit(0).cast("long")).withColumn(HALO, F.lit(False)).unionByName(
        blocks.withColumn(HALO, F.col(BLOCK) > F.col("_own")).drop("_own")
    )
    done = build(both, Window.partitionBy(layout.entity, BLOCK).orderBy(*layout.order))
    return done.where(~F.col(HALO)).drop(BLOCK, HALO)


def _time_blocks(df: DataFrame, layout: Layout) -> DataFrame:
    cold, hot = layout.split(df)
    return cold.withColumn(BLOCK, F.lit(0)).unionByName(
        layout.bucketed(hot).withColumnRenamed(BUCKET, BLOCK)
    )


def forward_fill(df: DataFrame, layout: Layout, cols: Sequence[str]) -> DataFrame:
    """Last non-null value so far within the entity."""
    def so_far(*parts: str) -> WindowSpec:
        return Window.partitionBy(*parts).orderBy(*layout.order).rowsBetween(Window.unboundedPreceding, 0)

    if layout.hot is None:
        w = so_far(layout.entity)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    src = _time_blocks(df, layout)
    before = Window.partitionBy(layout.entity).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    when = F.struct(*layout.order)
    carry = (
        src.groupBy(layout.entity, BLOCK)
        .agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), when)).alias(f"_c_{c}") for c in cols])
        .select(
            layout.entity,
            BLOCK,
            *[F.last(f"_c_{c}", ignorenulls=True).over(before).alias(f"_p_{c}") for c in cols],
        )
    )
    w = so_far(layout.entity, BLOCK)
    filled = src.join(carry, [layout.entity, BLOCK]).withColumns(
        {c: F.coalesce(F.last(c, ignorenulls=True).over(w), F.col(f"_p_{c}")) for c in cols}
    )
    return filled.select(*df.columns)


def running_sum(df: DataFrame, layout: Layout, sums: dict[str, Column]) -> DataFrame:
    """Running sums from the first row of the entity, one output column per entry."""
    src = df.withColumns({f"_x_{a}": e for a, e in sums.items()})
    if layout.hot is None:
        w = Window.partitionBy(layout.entity).orderBy(*layout.order).rowsBetween(Window.unboundedPreceding, 0)
        return src.select(*df.columns, *[F.sum(f"_x_{a}").over(w).alias(a) for a in sums])
    src = _time_blocks(src, layout)
    before = Window.partitionBy(layout.entity).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        src.groupBy(layout.entity, BLOCK)
        .agg(*[F.sum(f"_x_{a}").alias(f"_t_{a}") for a in sums])
        .select(
            layout.entity,
            BLOCK,
            *[F.coalesce(F.sum(f"_t_{a}").over(before), F.lit(0)).alias(f"_p_{a}") for a in sums],
        )
    )
    w = (
        Window.partitionBy(layout.entity, BLOCK)
        .orderBy(*layout.order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return src.join(carry, [layout.entity, BLOCK]).select(
        *df.columns, *[(F.col(f"_p_{a}") + F.sum(f"_x_{a}").over(w)).alias(a) for a in sums]
    )


def join_entity_stats(df: DataFrame, stats: DataFrame, layout: Layout, how: str = "left") -> DataFrame:
    """Join one stats row per entity; hot entities take it by broadcast instead of one reducer."""
    if layout.hot is None:
        return df.join(stats, layout.entity, how)
    cold, hot = layout.split(df)
    hot_stats = stats.join(F.broadcast(layout.hot), layout.entity, "left_semi")
    return cold.join(stats, layout.entity, how).unionByName(
        hot.join(F.broadcast(hot_stats), layout.entity, how)
    )
