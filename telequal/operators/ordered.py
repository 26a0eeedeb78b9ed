"""Exact order-dependent results without sorting all rows in one task.

A quantile sketch gives cut points, so every bucket holds about an equal share of the
rows whatever the distribution.  Per-bucket totals are tiny; their running sums are the
offsets from which each bucket is finished on its own.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from telequal.session import broadcast_if_small, shuffle_width

BUCKET = "_bucket"
# Buckets when only a few are read on: the finer, the less is left to shuffle.
SELECT_BUCKETS = 256
# Bytes of a frame per bucket, and the most buckets that one sketch places.
BUCKET_BYTES = 64 << 20
MOST_BUCKETS = 20_000
# Share of the rows that the quantile sketch looks at to place cut points.
SKETCH_SHARE = 0.2


def buckets_for(df: DataFrame) -> int:
    """Buckets for a column of ``df``: as many as tasks, more where the planner expects more data."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(shuffle_width(df.sparkSession), min(MOST_BUCKETS, size // BUCKET_BYTES))


def range_splits(df: DataFrame, value: str, n: int | None = None) -> list[float]:
    """Cut points of ``value`` into about ``n`` buckets of equal row count (one sketch job).

    A share of the rows is enough: cut points only balance the work, any cut points give exact results.
    """
    n = n or buckets_for(df)
    probs = [i / n for i in range(1, n)]
    sketch = F.percentile_approx(F.col(value).cast("double"), probs, 10 * n)
    cuts = df.sample(SKETCH_SHARE, seed=42).select(sketch.alias("cuts")).first().cuts or [0.0]
    return [float("-inf"), *sorted({c for c in cuts if math.isfinite(c)} or {0.0}), float("inf")]


def with_bucket(df: DataFrame, value: str, splits: list[float], out: str = BUCKET) -> DataFrame:
    """Add the bucket number of a double column (JVM-side binary search)."""
    raw = f"{out}_raw"
    bucketed = Bucketizer(splits=splits, inputCol=value, outputCol=raw, handleInvalid="keep").transform(df)
    return bucketed.withColumn(out, F.col(raw).cast("int")).drop(raw)


def running_totals(
    df: DataFrame,
    value: str,
    sums: Sequence[str],
    keys: Sequence[str] = (),
    fit_on: DataFrame | None = None,
    n: int | None = None,
) -> DataFrame:
    """Add ``cum_<c>`` (running, inclusive, ascending by ``value``) and ``total_<c>`` per ``keys``.

    ``df`` holds one row per (keys, value).  ``fit_on`` may name a cheaper frame with the
    same ``value`` column for the sketch.
    """
    splits = range_splits(fit_on if fit_on is not None else df, value, n)
    src = with_bucket(df.withColumn("_v", F.col(value).cast("double")), "_v", splits)
    every = Window.partitionBy(*keys)
    before = every.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    totals = src.groupBy(*keys, BUCKET).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    offsets = totals.select(
        *keys,
        BUCKET,
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *[F.sum(f"_t_{c}").over(every).alias(f"total_{c}") for c in sums],
    )
    inside = Window.partitionBy(*keys, BUCKET).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    return src.join(offsets, [*keys, BUCKET]).select(
        *df.columns,
        *[(F.col(f"_o_{c}") + F.sum(c).over(inside)).alias(f"cum_{c}") for c in sums],
        *[f"total_{c}" for c in sums],
    )


def order_statistics(
    df: DataFrame,
    value: str,
    ranks: dict[str, Callable[[Column], Column]],
    keys: Sequence[str] = (),
    few_keys: bool = False,
    n: int | None = None,
) -> DataFrame:
    """Exact values at 0-based ranks: one row per ``keys`` with ``n`` and a column per rank.

    Null and NaN count as missing.  Each rank is a function of the row count column.  Raw rows are never shuffled: bucket
    totals are combined map-side, and only the buckets that hold a wanted rank are read on.
    ``few_keys`` states that ``keys`` take a set of values fixed in code (column names); other keys are
    broadcast only after their number is checked.
    """
    src = df.select(*keys, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)")
    n = n or max(SELECT_BUCKETS, buckets_for(src))
    src = with_bucket(src, "_v", range_splits(src, "_v", n))
    every = Window.partitionBy(*keys)
    before = every.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    located = (
        src.groupBy(*keys, BUCKET)
        .agg(F.count(F.lit(1)).alias("_t"))
        .select(
            *keys,
            BUCKET,
            F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"),
            "_t",
            F.sum("_t").over(every).alias("n"),
        )
    )
    wanted = {alias: f(F.col("n")).cast("long") for alias, f in ranks.items()}
    hit = located.where(
        reduce(or_, [(r >= F.col("_off")) & (r < F.col("_off") + F.col("_t")) for r in wanted.values()])
    ).drop("_t")
    hit = F.broadcast(hit) if few_keys or not keys else broadcast_if_small(hit)
    inside = Window.partitionBy(*keys, BUCKET).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        src.join(hit, [*keys, BUCKET])
        .groupBy(*keys, BUCKET, "_off", "n", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_end", F.col("_off") + F.sum("_c").over(inside))
    )
    return placed.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[
            F.max(F.when((r >= F.col("_end") - F.col("_c")) & (r < F.col("_end")), F.col("_v"))).alias(alias)
            for alias, r in wanted.items()
        ],
    )


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: dict[str, float],
    keys: Sequence[str] = (),
    few_keys: bool = False,
    n: int | None = None,
) -> DataFrame:
    """Linear-interpolation quantiles of several columns: (keys, column, n, <alias per prob>)."""
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(keys), list(cols), "column", "value"
    )
    ranks = {}
    for alias, p in probs.items():
        ranks[f"_lo_{alias}"] = lambda cnt, p=p: F.floor((cnt - 1) * F.lit(float(p)))
        ranks[f"_hi_{alias}"] = lambda cnt, p=p: F.ceil((cnt - 1) * F.lit(float(p)))
    found = order_statistics(long, "value", ranks, [*keys, "column"], few_keys or not keys, n)

    def between(alias: str, p: float) -> Column:
        pos = (F.col("n") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo_{alias}"), F.col(f"_hi_{alias}")
        return (lo + (hi - lo) * (pos - F.floor(pos))).alias(alias)

    return found.select(*keys, "column", "n", *[between(a, p) for a, p in probs.items()])


def approx_quantiles(
    df: DataFrame, cols: Sequence[str], probs: dict[str, float], keys: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """Same shape as :func:`exact_quantiles` in a single pass, with rank error 1/accuracy."""
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(keys), list(cols), "column", "value"
    )
    return long.groupBy(*keys, "column").agg(
        F.count("value").alias("n"),
        *[F.percentile_approx("value", p, accuracy).alias(a) for a, p in probs.items()],
    )


def per_column_struct(long: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn (column, fields...) rows into one row with one struct per column."""
    return long.agg(
        *[
            F.struct(*[F.max(F.when(F.col("column") == c, F.col(f))).alias(f) for f in fields]).alias(c)
            for c in cols
        ]
    )


def fitted_row(df: DataFrame) -> Row:
    """Run a fit once and take its single row; its values enter later plans as constants."""
    return df.first()


def instant(micros: float | int | None) -> Column:
    """A fitted point in time as a timestamp constant, free of any local time zone."""
    return F.timestamp_micros(F.lit(None if micros is None else int(micros)).cast("bigint"))


def number(value: float | int | None) -> Column:
    """A fitted number as a double constant."""
    return F.lit(value).cast("double")
