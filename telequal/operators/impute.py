"""Missing values: constants, medians, modes, forward fill and their chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telequal.operators.ordered import exact_quantiles, fitted_row, number, per_column_struct
from telequal.operators.panel import Layout, forward_fill
from telequal.session import broadcast_if_small, durable


def constant_fill(df: DataFrame, values: dict[str, float | int | str]) -> DataFrame:
    return df.fillna(values)


def _known(df: DataFrame, c: str) -> Column:
    """A column with NaN as null."""
    if df.schema[c].dataType.typeName() in ("double", "float"):
        return F.when(~F.isnan(c), F.col(c))
    return F.col(c)


def medians(df: DataFrame, cols: Sequence[str], group: str | None = None) -> DataFrame:
    """Exact medians (column, n, median), per group value if given."""
    return exact_quantiles(df, cols, {"median": 0.5}, [group] if group else [])


def median_fill(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    fitted = fitted_row(per_column_struct(medians(fit_on if fit_on is not None else df, cols), cols, ["median"]))
    return df.withColumns({c: F.coalesce(_known(df, c), number(fitted[c]["median"])) for c in cols})


def group_median_fill(
    df: DataFrame, cols: Sequence[str], group: str, fit_on: DataFrame | None = None
) -> DataFrame:
    """Fill with the median of the row's group, such as its device type."""
    src = (fit_on if fit_on is not None else df).where(F.col(group).isNotNull())
    found = exact_quantiles(src, cols, {"median": 0.5}, [group])
    wide = found.groupBy(group).agg(
        *[F.max(F.when(F.col("column") == c, F.col("median"))).alias(f"_m_{c}") for c in cols]
    )
    joined = df.join(broadcast_if_small(wide), group, "left")
    return joined.withColumns({c: F.coalesce(_known(df, c), F.col(f"_m_{c}")) for c in cols}).select(*df.columns)


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the most frequent value per column; ties go to the smallest value."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    counts = long.where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("rank"), "value")).alias("best"))
    return best.agg(*[F.max(F.when(F.col("column") == c, F.col("best.value"))).alias(c) for c in cols])


def mode_fill(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    fitted = fitted_row(modes(fit_on if fit_on is not None else df, cols))
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(fitted[c]).cast(df.schema[c].dataType)) for c in cols}
    )


def impute_chain(
    df: DataFrame,
    layout: Layout,
    carried: Sequence[str],
    group: str | None = None,
    grouped: Sequence[str] = (),
    constants: dict[str, float | int | str] | None = None,
) -> DataFrame:
    """Forward fill ``carried``; then the (group) median for what is left; then constants."""
    out = forward_fill(df, layout, carried)
    rest = [*carried, *grouped]
    if rest:
        out = durable(out)  # the medians read it more than once
    if group:
        out = group_median_fill(out, rest, group)
    elif rest:
        out = median_fill(out, rest)
    return constant_fill(out, constants) if constants else out


def impute_customers(
    df: DataFrame, zero: Sequence[str], numbers: Sequence[str], categories: Sequence[str]
) -> DataFrame:
    """Snapshot tables: absent network events count 0, numbers take medians, categories modes."""
    src = df.fillna(0, [c for c in zero if c in df.columns])
    src = median_fill(src, [c for c in numbers if c not in zero])
    return mode_fill(src, categories)
