"""Runs from carried tails equal one batch, whatever the cuts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from telequal.operators import features, incremental
from telequal.operators.panel import forward_fill, measure
from telequal.plans import views

ORDER = ("ts", "seq")


@pytest.fixture(scope="module")
def readings(spark):
    t = views.tele_nulled(spark, "/root/testdata/sf0.001").select("entity", "ts", "seq", "signal")
    # Long gaps: a value may have to be carried over more rows than a window has.
    return t.withColumn("signal", F.when((F.col("entity") != 3) | (F.col("seq") % 40 == 0), F.col("signal"))).cache()


@pytest.mark.parametrize("rows", [168, 12])
def test_runs_equal_batch(readings, rows):
    layout = measure(readings, "entity", ORDER)
    want = features.rolling_baseline(forward_fill(readings, layout, ["signal"]), layout, "signal", rows=rows, least=5)
    days = F.dayofyear("ts")
    got, tail = None, None
    for part in (days <= 3, (days > 3) & (days <= 4), days > 4):
        made, tail = incremental.advance(readings.where(part), tail, "entity", ORDER, ["signal"], "signal", rows, 5)
        got = made if got is None else got.unionByName(made)
    both = got.join(want.withColumnsRenamed({"base_mean": "m", "base_std": "s", "signal": "v"}), ["entity", "ts", "seq"])
    assert both.count() == got.count() == readings.count()
    close = "v <=> signal AND (m <=> base_mean OR abs(m - base_mean) < 1e-9) AND (s <=> base_std OR abs(s - base_std) < 1e-9)"
    assert both.where(f"NOT ({close})").count() == 0
    assert tail.groupBy("entity").count().agg(F.max("count")).first()[0] <= rows - 1


def test_late_rows_are_told_apart(readings):
    early, rest = readings.where("seq % 2 = 0"), readings.where("seq % 2 = 1")
    _, tail = incremental.advance(early.where(F.dayofyear("ts") <= 4), None, "entity", ORDER, ["signal"], "signal")
    fit, late = incremental.split_late(rest, tail, "entity", ORDER)
    last = {r["entity"]: (r["t"], r["s"]) for r in tail.groupBy("entity").agg(F.max(F.struct(*ORDER)).alias("x")).select("entity", F.col("x.ts").alias("t"), F.col("x.seq").alias("s")).collect()}
    assert fit.count() + late.count() == rest.count() and late.count() > 0
    assert all((r["ts"], r["seq"]) <= last[r["entity"]] for r in late.collect())
    assert all(r["entity"] not in last or (r["ts"], r["seq"]) > last[r["entity"]] for r in fit.collect())


def test_empty_runs(readings):
    made, tail = incremental.advance(readings.limit(0), None, "entity", ORDER, ["signal"], "signal")
    assert made.count() == 0 and tail.count() == 0
    _, tail = incremental.advance(readings, None, "entity", ORDER, ["signal"], "signal")
    made, again = incremental.advance(readings.limit(0), tail, "entity", ORDER, ["signal"], "signal")
    assert made.count() == 0 and again.exceptAll(tail).count() == 0
