"""Least squares for every group at once: one aggregate of cross-moments, solved in expressions.

A group's moments are one flat array, row by row, of the sums of products of its columns, the target last.  *Sweeping* a
column (a Gauss-Jordan step) puts it into the regression; after sweeping x1..xk the array holds the inverse of their
moments, the coefficients in its last column, and the squared error in its last cell.  Columns swept in turn give all
nested models from the same moments.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A column is left out if this little of its sum of squares is not explained by the columns before it.
COLLINEAR = 1e-10


def cross_moments(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, n, moments) over the rows in which no column is null, summed map-side first."""
    known = df.where(reduce(and_, [F.col(c).isNotNull() for c in columns]))
    sums = {
        (a, b): F.sum(F.col(columns[a]) * F.col(columns[b])).alias(f"_m{a}_{b}")
        for a in range(len(columns))
        for b in range(a, len(columns))
    }
    found = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums.values())
    cells = [F.col(f"_m{min(a, b)}_{max(a, b)}").cast("double") for a in range(len(columns)) for b in range(len(columns))]
    return found.select(*keys, "n", F.array(*cells).alias("moments"))


def cell(m: Column, size: int, row: Column | int, column: Column | int) -> Column:
    return F.get(m, (row if isinstance(row, Column) else F.lit(row)) * size + column)


def usable(m: Column, start: Column, size: int, k: Column | int) -> Column:
    """Whether column ``k`` still adds something to those swept before it; ``start`` are the moments before any sweep."""
    return cell(m, size, k, k) > cell(start, size, k, k) * COLLINEAR


def swept(m: Column, start: Column, size: int, k: Column | int) -> Column:
    """The array with column ``k`` swept; a collinear column is emptied, so that its coefficient is 0."""
    k = k if isinstance(k, Column) else F.lit(k)
    d = cell(m, size, k, k)

    def put_in(x: Column, at: Column) -> Column:
        i, j = F.floor(at / F.lit(size)).cast("int"), at % F.lit(size)
        return (
            F.when((i == k) & (j == k), F.lit(1.0) / d)
            .when(i == k, x / d)
            .when(j == k, -x / d)
            .otherwise(x - cell(m, size, i, k) * cell(m, size, k, j) / d)
        )

    def leave_out(x: Column, at: Column) -> Column:
        i, j = F.floor(at / F.lit(size)).cast("int"), at % F.lit(size)
        return F.when((i == k) | (j == k), F.lit(0.0)).otherwise(x)

    return F.when(usable(m, start, size, k), F.transform(m, put_in)).otherwise(F.transform(m, leave_out))


def solve(df: DataFrame, size: int, out: str = "solved") -> DataFrame:
    """Add ``out``: ``moments`` of ``size`` columns with all but the last swept."""
    start = F.col("moments")
    return df.withColumn(
        out,
        F.aggregate(F.sequence(F.lit(0), F.lit(size - 2)), start, lambda m, k: swept(m, start, size, k)),
    )


def coefficient(m: Column, size: int, k: int) -> Column:
    """Coefficient of column ``k`` in a solved array."""
    return cell(m, size, k, size - 1)


def squared_error(m: Column, size: int) -> Column:
    return F.greatest(cell(m, size, size - 1, size - 1), F.lit(0.0))
