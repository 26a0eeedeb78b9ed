"""Plans: pruning, pushdown, no Python in SQL-only operators, partial limits before shuffles."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from telequal.operators import dedup, stats
from telequal.operators.panel import measure
from telequal.operators import features
from telequal.plans import views
from telequal.plans.catalog import QUERIES
from telequal.sources import sinks, tables

DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_projection_reaches_the_scan(spark):
    p = plan(QUERIES["scan_project"](spark, DIR))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in p


def test_in_list_is_pushed(spark):
    assert "In(event_type, [error,purchase])" in plan(QUERIES["scan_pushdown_in"](spark, DIR))


def test_long_list_becomes_a_semi_join(spark):
    o = tables.table(spark, DIR, "orders")
    got = tables.only_keys(o, "o_custkey", list(range(0, 3000, 2)))
    assert "LeftSemi" in plan(got)
    assert got.where("o_custkey % 2 = 1").count() == 0


def test_date_folders_are_pruned(spark, tmp_path):
    path = str(tmp_path / "by_date")
    e = tables.table(spark, DIR, "events").withColumn("timestamp", F.col("ts").cast("timestamp"))
    sinks.write_by_date(e, path)
    sinks.write_by_date(e, path)
    since = F.lit("2024-01-20 06:00:00").cast("timestamp")
    df = tables.scan(spark, path, ["event_id"], since=since)
    p = plan(df)
    assert "PartitionFilters: [isnotnull(date" in p and "date#" in p.split("PartitionFilters")[1]
    assert df.count() == e.where(F.col("timestamp") >= since).count()
    assert tables.scan(spark, path).count() == e.count()


def test_dedup_is_limited_before_the_shuffle(spark):
    p = plan(dedup.keep_last(views.tele(spark, DIR), ["entity", "ts"], ["seq"]))
    below = p.split("Exchange")[1]
    assert "WindowGroupLimit" in below


def test_top_k_never_sorts_everything(spark):
    assert "TakeOrderedAndProject" in plan(stats.topk(views.tele(spark, DIR), "signal", 5, "seq"))


def test_rolling_features_take_one_shuffle(spark):
    t = views.tele(spark, DIR)
    layout = measure(t, "entity", ("ts", "seq"))
    df = features.rolling_std(t, layout, "signal", "a")
    df = features.rolling_baseline(df, layout, "signal")
    assert plan(df).count("Exchange hashpartitioning") == 1


SQL_ONLY = [
    "ffill", "rolling_baseline", "sigma_breach", "time_split", "roc_auc", "stratified_split", "panel_sar_forecast",
    "cross_signal_flag", "iqr_cap", "impute_chain",
]


@pytest.mark.parametrize("name", SQL_ONLY)
def test_no_python_and_no_product(spark, name):
    p = plan(QUERIES[name](spark, DIR))
    for word in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert word not in p
