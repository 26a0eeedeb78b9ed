"""Inputs the test tables lack: NaN, ties, constants, short series, missing scores, empty frames."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telequal import session
from telequal.operators import churn, evaluate, forecast, impute, outliers, quality, split, stats


def test_long_integers_keep_their_digits(spark):
    df = spark.createDataFrame([("12345678901234567",), ("7.0",), ("x",), (None,)], "n string")
    out = quality.coerce_schema(df, T.StructType([T.StructField("n", T.LongType())])).collect()
    assert [r["n"] for r in out] == [12345678901234567, 7, None, None]


def test_nan_is_missing_for_medians_and_bounds(spark):
    df = spark.createDataFrame([(float(x), 0) for x in (1, 2, 3)] + [(math.nan, 0)] * 2, "x double, flag int")
    assert impute.medians(df, ["x"]).first()["median"] == 2.0
    assert sorted(r["x"] for r in impute.median_fill(df, ["x"]).collect()) == [1, 2, 2, 2, 3]
    assert not any(math.isnan(v) for v in outliers.iqr_bounds(df, ["x"], "flag").first() if isinstance(v, float))


def test_samples_and_splits_have_the_asked_size_when_all_rows_tie(spark):
    df = spark.range(1000).select(F.lit(1).alias("a"), (F.col("id") % 2).alias("y"))
    same = F.lit(5.0)
    assert split.uniform_sample(df, same, 8).count() == 8
    assert split.uniform_sample(df, same, 5000).count() == 1000
    got = {r["y"]: r["count"] for r in split.stratified_sample(df, "y", same, 100).groupBy("y").count().collect()}
    assert got == {0: 100, 1: 20}
    sizes = {r["split"]: r["count"] for r in split.stratified_split(df, "y", same).groupBy("split").count().collect()}
    assert sum(sizes.values()) == 1000 and sizes["test"] == 2 * round(500 * split.TEST_SIZE)


def test_keys_beyond_the_mix_range_keep_the_sample_size(spark):
    df = spark.range(9000).select((F.col("id") + (F.col("id") % 2) * 2_147_483_647).alias("k"))
    assert split.uniform_sample(df, split.mix(F.col("k")), 5001).count() == 5001


def test_constant_column_has_one_histogram_bin(spark):
    df = spark.createDataFrame([(4.0, 0), (4.0, 1)], "x double, y int")
    assert {(r["label"], r["bin"], r["n"]) for r in stats.label_histogram(df, "x", "y").collect()} == {(0, 0, 1), (1, 0, 1)}


def test_share_of_all_zero_is_null(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 0.0)], "f string, v double")
    assert {r["pct_of_max"] for r in stats.importance_share(df, "v").collect()} == {None}


def test_null_audit_of_an_empty_frame(spark):
    assert quality.null_audit(spark.createDataFrame([], "a int, b double")).collect()[0]["pct"] is None


def _hours(spark, lengths):
    rows = [(s, h, float(f(h))) for s, (n, f) in lengths.items() for h in range(n)]
    df = spark.createDataFrame(rows, "series string, h int, y double")
    return df.withColumn("ts", F.timestamp_seconds(F.col("h") * 3600)).select("series", "ts", "y")


def test_one_odd_series_does_not_end_the_job(spark):
    wavy = lambda h: math.sin(h / 3) + (h * 7919 % 13) / 7
    panel = _hours(spark, {"good": (400, wavy), "three": (3, wavy), "line": (100, lambda h: h)})
    got = {r["series"]: r for r in forecast.df_stationarity(panel).collect()}
    assert set(got) == {"good", "three", "line"}
    assert got["good"]["statistic"] is not None and got["line"]["statistic"] is None
    res = _hours(spark, {"good": (400, wavy), "zero": (100, lambda h: 0)}).withColumnRenamed("y", "e")
    tests = {r["series"]: r for r in forecast.ljung_box(res).collect()}
    assert tests["good"]["q10"] is not None and tests["zero"]["q10"] is None


def test_short_series_stay_with_a_reason(spark):
    wavy = lambda h: math.sin(h / 3) + (h * 7919 % 13) / 7
    panel = _hours(spark, {"long": (400, wavy), "thirty": (30, wavy), "sixty": (60, wavy), "ten": (10, wavy)})
    frame = forecast.seasonal_frame(panel)
    fit = forecast.panel_sar_fit(frame)
    got = {r["series"]: r for r in fit.collect()}
    assert set(got) == {"long", "thirty", "sixty", "ten"}
    assert got["long"]["reason"] is None and got["ten"]["reason"] == "too little history" and got["ten"]["phi"] is None
    ahead = forecast.panel_sar_horizon(frame, fit, 5).collect()
    by = {s: [r["forecast"] for r in ahead if r["series"] == s] for s in got}
    assert all(len(v) == 5 for v in by.values())
    assert None not in by["long"] and None not in by["thirty"] and by["ten"] == [None] * 5
    assert {r["series"] for r in forecast.panel_sar_forecast(frame, fit).collect()} == set(got)


def test_a_row_without_a_score_is_a_missed_positive(spark):
    df = spark.createDataFrame([(1, 0.9), (1, None), (0, 0.1)], "y int, s double")
    m = evaluate.confusion_metrics(df, "y", F.col("s") > 0.5).first()
    assert (m["tp"], m["fn"], m["tn"], m["fp"], m["recall"]) == (1, 1, 1, 0, 0.5)
    curve = evaluate.pr_curve(df, "y", "s").where("threshold = 0.9").first()
    assert curve["recall"] == 0.5


def test_background_of_equal_rows_stays_at_the_asked_size(spark):
    base = spark.createDataFrame([(1.0, 2.0)] * 1000, "a double, b double")
    rows = spark.createDataFrame([(1, 3.0, 5.0)], "k int, a double, b double")
    got = churn.sampled_attribution(rows, base, ["a", "b"], "k", lambda d: d.withColumn("s", F.col("a") + F.col("b")), "s", 3, background_rows=4)
    assert {r["feature"]: r["attribution"] for r in got.collect()} == {"a": 2.0, "b": 3.0}


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(_, default=None):
                return default

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_broadcast_is_bounded_by_rows_and_bytes(spark):
    df = spark.range(100)
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().logical().toString() or "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(session.broadcast_if_small(df))
    assert not hinted(session.broadcast_if_small(df, max_rows=10))
    assert not hinted(session.broadcast_if_small(df, max_bytes=10))
