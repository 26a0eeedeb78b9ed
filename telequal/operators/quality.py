"""Schema coercion, range and rule checks, null audits and the cleaning report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telequal.operators.ordered import fitted_row, number

REPORT_SCHEMA = "step string, column string, metric string, value double"


def _kind(t: T.DataType) -> str:
    if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "timestamp"
    if isinstance(t, T.FractionalType):
        return "double"
    if isinstance(t, T.IntegralType):
        return "bigint"
    return t.simpleString()


def coerced(name: str, actual: T.DataType, expected: T.DataType, zero_ints: bool) -> Column:
    """One column as its expected kind; text that does not parse becomes null (or 0)."""
    c = F.col(name)
    want = _kind(expected)
    if want == _kind(actual):
        return c
    if want == "timestamp":
        return c.try_cast("timestamp").alias(name)
    if want == "double":
        return c.try_cast("double").alias(name)
    if want == "bigint":
        # Digits are read as they are where they are an integer; only other notations go through a double.
        number = F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))
        return (F.coalesce(number, F.lit(0).cast("bigint")) if zero_ints else number).alias(name)
    return c.cast(expected).alias(name)


def coerce_schema(df: DataFrame, expected: T.StructType, zero_ints: bool = False) -> DataFrame:
    """Cast every column whose kind differs; other columns pass through."""
    want = {f.name: f.dataType for f in expected}
    return df.select(
        *[
            coerced(f.name, f.dataType, want[f.name], zero_ints) if f.name in want else F.col(f.name)
            for f in df.schema
        ]
    )


def schema_audit(df: DataFrame, expected: T.StructType) -> DataFrame:
    """(column, issue, expected, actual, rows, failed): missing columns, casts, and cells a cast loses."""
    actual = {f.name: f.dataType for f in df.schema}
    rows = []
    for f in expected:
        want = _kind(f.dataType)
        if f.name not in actual:
            rows.append((f.name, "missing", want, None, F.lit(0).cast("bigint")))
        elif _kind(actual[f.name]) != want:
            lost = F.count_if(
                F.col(f.name).isNotNull() & coerced(f.name, actual[f.name], f.dataType, False).isNull()
            )
            rows.append((f.name, "cast", want, actual[f.name].simpleString(), lost))
    items = [
        F.struct(
            F.lit(n).alias("column"),
            F.lit(i).alias("issue"),
            F.lit(e).alias("expected"),
            F.lit(a).cast("string").alias("actual"),
            F.lit(0).cast("bigint").alias("rows") if not rows else F.count(F.lit(1)).alias("rows"),
            x.alias("failed"),
        )
        for n, i, e, a, x in rows
    ]
    if not items:
        return df.sparkSession.createDataFrame(
            [], "column string, issue string, expected string, actual string, rows bigint, failed bigint"
        )
    return df.agg(F.array(*items).alias("issues")).select(F.inline("issues"))


def _outside(c: Column, lo: float, hi: float) -> Column:
    return (c < F.lit(lo)) | (c > F.lit(hi))


def null_out_of_range(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Readings outside the inclusive range become null; the row stays."""
    return df.withColumns(
        {c: F.when(F.col(c).between(lo, hi), F.col(c)) for c, (lo, hi) in ranges.items() if c in df.columns}
    )


def range_audit(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """(column, n_bad) for the columns with at least one value out of range, in one pass."""
    items = [
        F.struct(F.lit(c).alias("column"), F.count_if(_outside(F.col(c), lo, hi)).alias("n_bad"))
        for c, (lo, hi) in ranges.items()
        if c in df.columns
    ]
    return df.agg(F.array(*items).alias("bad")).select(F.inline("bad")).where("n_bad > 0")


def _rules(
    ranges: dict[str, tuple[float, float]], domains: dict[str, Sequence]
) -> list[tuple[str, Column]]:
    """(rule, violated) in order.  A null is inside any range but in no domain."""
    return [
        (c, F.coalesce(_outside(F.col(c), lo, hi), F.lit(False))) for c, (lo, hi) in ranges.items()
    ] + [(c, ~F.coalesce(F.col(c).isin(list(v)), F.lit(False))) for c, v in domains.items()]


def drop_rule_violations(
    df: DataFrame,
    ranges: dict[str, tuple[float, float]] | None = None,
    domains: dict[str, Sequence] | None = None,
) -> DataFrame:
    rules = _rules(ranges or {}, domains or {})
    return df.where(reduce(and_, [~bad for _, bad in rules]))


def rule_violations(
    df: DataFrame,
    ranges: dict[str, tuple[float, float]] | None = None,
    domains: dict[str, Sequence] | None = None,
) -> DataFrame:
    """(rule, n_bad): each row counts for the first rule it breaks, as if rules ran in turn."""
    rules = _rules(ranges or {}, domains or {})
    first = reduce(lambda acc, r: acc.when(r[1], r[0]), rules[1:], F.when(rules[0][1], rules[0][0]))
    return df.select(first.alias("rule")).where("rule is not null").groupBy("rule").agg(
        F.count(F.lit(1)).alias("n_bad")
    )


def _missing(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    fractional = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return c.isNull() | F.isnan(c) if fractional else c.isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """Treat NaN as missing, as the pandas-based tools that write such files do."""
    return df.withColumns(
        {
            f.name: F.when(~F.isnan(F.col(f.name)), F.col(f.name))
            for f in df.schema
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        }
    )


def null_audit(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n_null, pct) over all rows, one pass; ``pct`` is null without rows."""
    items = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(_missing(df, c)).alias("n_null"),
            (F.try_divide(F.count_if(_missing(df, c)), F.count(F.lit(1))) * 100).alias("pct"),
        )
        for c in cols or df.columns
    ]
    return df.agg(F.array(*items).alias("audit")).select(F.inline("audit"))


def report_rows(df: DataFrame, step: str, label: str, metrics: Sequence[str]) -> DataFrame:
    """Bring any audit frame into the long report layout (step, column, metric, value)."""
    return df.select(
        F.lit(step).alias("step"),
        F.col(label).cast("string").alias("column"),
        F.inline(
            F.array(
                *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
            )
        ),
    )


def quality_report(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def clip(c: Column, lo: Column, hi: Column) -> Column:
    """Null stays null, unlike greatest/least."""
    return F.when(c < lo, lo).when(c > hi, hi).otherwise(c)


def clip_to(df: DataFrame, bounds: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Clip ``cols`` to a one-row frame of ``<col>`` structs with ``lower`` and ``upper``."""
    b = fitted_row(bounds)
    return df.withColumns({c: clip(F.col(c), number(b[c]["lower"]), number(b[c]["upper"])) for c in cols})
