"""Preparation of new readings from what the last run has left, without reading history again.

What later rows can depend on is small: the last value of every filled column and the values in one baseline window.  Both are
in the *tail*, the last ``BASELINE_ROWS - 1`` prepared rows of every entity.  A run takes the tail and the new rows, and
returns the new rows prepared and the next tail.  Day by day this gives the rows of one batch over everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telequal.operators.features import rolling_baseline
from telequal.operators.panel import forward_fill, measure
from telequal.schemas import BASELINE_MIN_ROWS, BASELINE_ROWS
from telequal.session import durable


def tail(prepared: DataFrame, entity: str, order: Sequence[str], rows: int = BASELINE_ROWS - 1) -> DataFrame:
    """The last rows of every entity, limited inside each map task before the shuffle."""
    newest = Window.partitionBy(entity).orderBy(*[F.col(c).desc() for c in order])
    return prepared.withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= rows).drop("_back")


def split_late(new: DataFrame, carried: DataFrame, entity: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows after the last prepared row of their entity, rows at or before it, which come too late)."""
    last = carried.groupBy(entity).agg(F.max(F.struct(*order)).alias("_last"))
    judged = new.join(last, entity, "left").withColumn("_late", F.coalesce(F.struct(*order) <= F.col("_last"), F.lit(False)))
    return judged.where("NOT _late").select(*new.columns), judged.where("_late").select(*new.columns)


def advance(
    new: DataFrame,
    carried: DataFrame | None,
    entity: str,
    order: Sequence[str],
    filled: Sequence[str],
    baseline: str,
    rows: int = BASELINE_ROWS,
    least: int = BASELINE_MIN_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(new rows with ``filled`` carried forward, ``base_mean`` and ``base_std`` of ``baseline``; the next tail).

    ``carried`` is the tail of the run before, or None in the first.  Rows of an entity must come after its last prepared one;
    :func:`split_late` tells those that do not.  Entities without new rows keep their tail.  Both results are written tables.
    """
    columns = new.columns
    both = new.withColumn("_new", F.lit(True))
    if carried is not None:
        both = carried.select(*columns).withColumn("_new", F.lit(False)).unionByName(both)
    both = durable(both)
    layout = measure(both, entity, order)
    done = durable(forward_fill(both, layout, filled))
    next_tail = durable(tail(done.drop("_new"), entity, order, rows - 1))
    based = rolling_baseline(done, layout, baseline, rows=rows, least=least)
    return durable(based.where("_new").drop("_new")), next_tail
