"""Samples and splits that are repeatable and free of leakage."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telequal.functions.numbers import steady_round
from telequal.operators.ordered import fitted_row, instant, number, order_statistics
from telequal.schemas import TEST_SIZE, TRAIN_SHARE, VALIDATION_SIZE
from telequal.session import broadcast_if_small

MIX_PRIME = 2_147_483_647


def mix(key: Column, seed: int | Column = 42) -> Column:
    """A repeatable shuffling order for integer keys: a one-to-one map on 0..prime-1 in plain arithmetic."""
    p = F.lit(MIX_PRIME).cast("bigint")
    x = F.pmod(F.pmod(key.cast("bigint"), p) * 48_271 + seed, p)
    square = F.pmod(x * x, p)
    return F.pmod(F.pmod(square * square, p) * x, p)


def hashed(*keys: str, seed: int = 42) -> Column:
    """Shuffling order for any keys (53 bits, so that it is exact as a double)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11)


def time_split_boundary(df: DataFrame, ts: str, share: float = TRAIN_SHARE) -> DataFrame:
    """One row (n, boundary): the timestamp at sorted position int(share * n)."""
    micros = df.select(F.unix_micros(F.col(ts).cast("timestamp")).alias("_at"))
    found = order_statistics(micros, "_at", {"at": lambda n: F.floor(n * F.lit(float(share)))})
    return found.select("n", F.timestamp_micros(F.col("at").cast("bigint")).alias("boundary"))


def time_split(df: DataFrame, ts: str, share: float = TRAIN_SHARE, out: str = "split") -> DataFrame:
    """'train' strictly before the boundary, 'test' from it on."""
    edge = instant(fitted_row(time_split_boundary(df, ts, share).select(F.unix_micros("boundary")))[0])
    return df.withColumn(out, F.when(F.col(ts) < edge, "train").otherwise("test"))


def split_summary(df: DataFrame, label: str, entity: str, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(label).alias("label_rate"),
        F.countDistinct(entity).alias("n_entities"),
    )


def _first_rows(src: DataFrame, label: str, wanted: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """``src`` (with ``_order``) with a flag per name: among the first ``wanted(n)`` of the n rows of its class.

    Order values decide; only rows that share the value at a boundary are ranked, by a hash of their columns, so
    sizes are exact however many rows tie.
    """
    ranks = {f"_at_{k}": lambda n, f=f: F.least(f(n), n - 1) for k, f in wanted.items()}
    cuts = broadcast_if_small(order_statistics(src, "_order", ranks, [label]).withColumnRenamed("n", "_n"))
    placed = src.join(cuts, label)
    below = placed.groupBy(label).agg(*[F.count_if(F.col("_order") < F.col(f"_at_{k}")).alias(f"_below_{k}") for k in wanted])
    placed = placed.join(broadcast_if_small(below), label)
    tied = reduce(or_, [F.col("_order") == F.col(f"_at_{k}") for k in wanted])
    by_hash = Window.partitionBy(label, "_order").orderBy(F.xxhash64(*[F.col(c) for c in src.columns]))
    rest = placed.where(~tied).withColumn("_rank", F.lit(0))
    ranked = placed.where(tied).withColumn("_rank", F.row_number().over(by_hash))

    def inside(k: str, f: Callable[[Column], Column]) -> Column:
        at = F.col(f"_at_{k}")
        taken = F.col("_rank") <= f(F.col("_n")) - F.col(f"_below_{k}")
        return (F.col("_order") < at) | ((F.col("_order") == at) & taken)

    return rest.unionByName(ranked).withColumns({f"_first_{k}": inside(k, f) for k, f in wanted.items()})


def stratified_split(
    df: DataFrame,
    label: str,
    order: Column,
    test_size: float = TEST_SIZE,
    val_size: float = VALIDATION_SIZE,
    out: str = "split",
) -> DataFrame:
    """train/val/test with the class shares kept.

    Per class the first ``test_size`` rows in shuffling order are the test set and the next
    ``val_size`` of the rest the validation set.  Two order values per class decide, so no class
    is ever gathered.
    """

    def n_test(n: Column) -> Column:
        return F.round(n * F.lit(test_size))

    def n_held(n: Column) -> Column:
        return n_test(n) + F.round((n - n_test(n)) * F.lit(val_size))

    placed = _first_rows(df.withColumn("_order", order), label, {"test": n_test, "held": n_held})
    split = F.when(F.col("_first_test"), "test").when(F.col("_first_held"), "val").otherwise("train")
    return placed.withColumn(out, split).select(*df.columns, out)


def stratified_sample(df: DataFrame, label: str, order: Column, n: int, ratio: int = 5) -> DataFrame:
    """Up to ``n`` rows of class 0 and ``n // ratio`` of every other class."""
    size = F.when(F.col(label) == 0, F.lit(n)).otherwise(F.lit(n // ratio))
    placed = _first_rows(df.withColumn("_order", order), label, {"cut": lambda _: size})
    return placed.where("_first_cut").select(*df.columns)


def uniform_sample(df: DataFrame, order: Column, n: int) -> DataFrame:
    """``n`` rows (all, if fewer) in shuffling order; rows that tie at the end are taken in the order of a hash."""
    src = df.withColumn("_order", order)
    found = fitted_row(order_statistics(src, "_order", {"cut": lambda cnt: F.least(F.lit(n), cnt) - 1}))
    cut = number(found["cut"] if found else None)
    below = src.where(F.col("_order") < cut)
    ties = src.where(F.col("_order") == cut).orderBy(F.xxhash64(*[F.col(c) for c in df.columns]))
    return below.union(ties.limit(max(0, n - below.count()))).drop("_order")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """One row: n, n_pos, n_neg, pos_rate and the weight of a positive row."""
    n, pos = F.count(F.lit(1)), F.count_if(F.col(label) == 1)
    return df.agg(
        n.alias("n"),
        pos.alias("n_pos"),
        (n - pos).alias("n_neg"),
        steady_round(F.when(n > 0, pos / n), 4).alias("pos_rate"),
        steady_round(F.when(pos > 0, (n - pos) / pos), 4).alias("pos_weight"),
    )


def oversample(df: DataFrame, label: str, copy: str = "copy_no") -> DataFrame:
    """Repeat every positive row round(weight) times in all (at least once); ``copy_no`` starts at 1."""
    weight = fitted_row(class_balance(df, label))["pos_weight"] or 1.0
    times = F.when(F.col(label) == 1, max(1, round(weight))).otherwise(1)
    return df.withColumn(copy, F.explode(F.sequence(F.lit(1), times)))


def union_sources(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
