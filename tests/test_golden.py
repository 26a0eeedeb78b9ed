"""Small frames for null, tie and rounding semantics that the test tables lack."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from telequal.functions import rules
from telequal.functions.calendar import calendar_features, days_between
from telequal.operators import dedup, encode, evaluate, features, impute, outliers, quality, signals, split
from telequal.operators.ordered import exact_quantiles
from telequal.operators.panel import forward_fill, measure


def vals(df, *cols):
    return [tuple(r) if len(cols) > 1 else r[0] for r in df.select(*cols).collect()]


def panel_frame(spark, rows):
    return spark.createDataFrame(rows, "e string, t int, x double").withColumn(
        "ts", F.timestamp_seconds(F.col("t") * 3600)
    )


def test_range_drop_keeps_null(spark):
    df = spark.createDataFrame([(None,), (5,), (99,)], "b int")
    assert sorted(vals(quality.drop_rule_violations(df, {"b": (0, 50)}), "b"), key=str) == [5, None]


def test_domain_drop_removes_null(spark):
    df = spark.createDataFrame([(None,), ("One year",), ("x",)], "contract string")
    assert vals(quality.drop_rule_violations(df, domains={"contract": ["One year"]}), "contract") == ["One year"]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(0, None), (1, -5.0), (2, 5.0), (3, 50.0)], "i int, x double")
    got = vals(df.withColumn("y", quality.clip(F.col("x"), F.lit(0.0), F.lit(10.0))).orderBy("i"), "y")
    assert got == [None, 0.0, 5.0, 10.0]


def test_coerce(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "n string")
    schema = T.StructType([T.StructField("n", T.LongType())])
    assert vals(quality.coerce_schema(df, schema), "n") == [1, None, None]
    assert vals(quality.coerce_schema(df, schema, zero_ints=True), "n") == [1, 0, 0]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert vals(quality.null_audit(df), "n_null") == [2]
    assert vals(quality.nan_to_null(df), "x") == [None, 1.0, None]


def test_ffill_stays_inside_entity(spark):
    df = panel_frame(spark, [("A", 1, 1.0), ("A", 2, None), ("A", 3, 3.0), ("B", 1, None), ("B", 2, 7.0)])
    out = forward_fill(df, measure(df, "e", ("ts",)), ["x"]).orderBy("e", "t")
    assert vals(out, "x") == [1.0, 1.0, 3.0, None, 7.0]


def test_rolling_min_periods(spark):
    df = panel_frame(spark, [("A", i, float(v)) for i, v in enumerate([1, 2, 4, 8, 16])])
    layout = measure(df, "e", ("ts",))
    loose = vals(features.rolling_std(df, layout, "x", "s").orderBy("t"), F.round("s", 4))
    strict = vals(features.rolling_std(df, layout, "x", "s", strict=True).orderBy("t"), F.round("s", 4))
    assert loose == [0.0, 0.7071, 1.5275, 3.0957, 6.1914]
    assert strict == [0.0, 0.0, 0.0, 3.0957, 6.1914]


def test_quartiles_and_label0_bounds(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (3.0, 0), (4.0, 0), (900.0, 1)], "x double, y int")
    b = outliers.iqr_bounds(df, ["x"], "y").first()
    assert (b.q1, b.q3, b.lower, b.upper) == (1.75, 3.25, -2.75, 7.75)
    out = outliers.iqr_cap(df, outliers.iqr_bounds(df, ["x"], "y"), ["x"])
    assert sorted(vals(out, "x")) == [1.0, 2.0, 3.0, 4.0, 7.75]


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("a",), (None,)], "c string")
    assert vals(impute.modes(df, ["c"]), "c") == ["a"]
    assert vals(impute.mode_fill(df, ["c"]), "c")[-1] == "a"


def test_label_codes_and_unseen(spark):
    df = spark.createDataFrame([("Two year",), ("Month-to-month",), ("One year",)], "c string")
    codes = encode.fit_label_codes(df, ["c"])
    new = spark.createDataFrame([("Two year",), ("never seen",), (None,)], "c string")
    got = dict(vals(encode.apply_label_codes(df, codes, ["c"]), "c", "c_code"))
    assert got == {"Two year": 2, "Month-to-month": 0, "One year": 1}
    assert vals(encode.apply_label_codes(new, codes, ["c"]), "c_code") == [2, 0, 0]


def test_keep_last_uses_whole_order(spark):
    df = spark.createDataFrame([(1, 10, 1), (1, 10, 2)], "k int, ts int, seq int")
    assert vals(dedup.keep_last(df, ["k"], ["ts", "seq"]), "seq") == [2]


def test_split_boundary(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 11)], "i int").withColumn("ts", F.timestamp_seconds("i"))
    parts = split.time_split(df, "ts").groupBy("split").agg(F.count("*").alias("n"), F.min("i").alias("lo"))
    assert {r.split: (r.n, r.lo) for r in parts.collect()} == {"train": (8, 1), "test": (2, 9)}
    tied = spark.createDataFrame([(1,), (1,), (1,), (2,), (2,)], "i int").withColumn("ts", F.timestamp_seconds("i"))
    got = split.time_split(tied, "ts").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in got} == {"train": 3, "test": 2}


def test_weekday_of_monday(spark):
    df = spark.sql("select timestamp'2024-01-01 20:00:00' as ts")
    row = df.select(*[c.alias(n) for n, c in calendar_features("ts").items()]).first()
    assert (row.day_of_week, row.hour_of_day, row.is_peak_hour, row.is_weekend) == (0, 20, 1, 0)
    assert row.hour_sin == round(math.sin(2 * math.pi * 20 / 24), 4)


def _scores(spark):
    return spark.createDataFrame([(0.1, 0), (0.5, 0), (0.5, 1), (0.9, 1)], "s double, y int")


def test_auc_ties_count_half(spark):
    assert evaluate.roc_auc(_scores(spark), "y", "s").first().auc == 0.875


def test_best_threshold(spark):
    curve = evaluate.pr_curve(_scores(spark), "y", "s")
    best = evaluate.best_f1_threshold(curve).first()
    assert (best.threshold, round(best.precision, 4), best.recall, round(best.f1, 4)) == (0.5, 0.6667, 1.0, 0.8)
    at9 = curve.where("threshold = 0.9").first()
    assert (at9.precision, at9.recall, round(at9.f1, 4)) == (1.0, 0.5, 0.6667)
    assert round(evaluate.average_precision(curve).first()[0], 6) == round(0.5 * 1 + 0.5 * 2 / 3, 6)


def test_strict_threshold_and_no_positive(spark):
    m = evaluate.confusion_metrics(_scores(spark), "y", F.col("s") > 0.5).first()
    assert (m.tp, m.fn, m.fp, m.tn) == (1, 1, 0, 2)
    none = evaluate.confusion_metrics(_scores(spark), "y", F.lit(False)).first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)


def test_one_class_auc_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert evaluate.roc_auc(df, "y", "s").first().auc is None


def test_severity_and_recency(spark):
    df = spark.createDataFrame([(0,), (300,), (900,)], "c int")
    assert vals(df, rules.severity_score(F.col("c"))) == [0.0, 0.5, 1.0]
    ts = spark.sql("select timestamp'2024-03-30 12:00:00' a, timestamp'2024-03-31 00:00:00' b")
    assert vals(ts, days_between(F.col("b"), F.col("a"))) == [0]
    keys = spark.createDataFrame([(1,), (2,)], "k int")
    src = spark.sql("select 1 as k, timestamp'2024-03-30 12:00:00' as last")
    got = signals.recency_days(keys, "k", [src], F.lit("2024-03-31").cast("timestamp"))
    assert dict(vals(got, "k", "days_since_last")) == {1: 0, 2: 90}


def test_reasons_stop_at_three(spark):
    df = spark.createDataFrame(
        [("Month-to-month", 3, 95.5, 0, 500, 50)],
        "contract_type string, tenure_months int, monthly_charges double, tech_support_flag int, "
        "anomaly_count_30d int, wifi_breach_count_30d int",
    )
    assert vals(df, rules.top_reasons())[0] == [
        "Month-to-month contract (highest churn risk)",
        "Short tenure (3 months)",
        "High monthly charges ($95.5)",
    ]


def test_quantile_of_nothing_and_constant(spark):
    empty = spark.createDataFrame([], "x double")
    assert exact_quantiles(empty, ["x"], {"m": 0.5}).count() == 0
    same = spark.createDataFrame([(3.0,)] * 7, "x double")
    assert exact_quantiles(same, ["x"], {"m": 0.5}).first().m == 3.0


def test_oversample_counts(spark):
    df = spark.createDataFrame([(1,)] * 10 + [(0,)] * 29, "y int")
    assert split.oversample(df, "y").where("y = 1").count() == 30  # weight 2.9 rounds to 3
    half = spark.createDataFrame([(1,)] * 2 + [(0,)] * 5, "y int")
    assert split.oversample(half, "y").where("y = 1").count() == 4  # 2.5 rounds to the even 2
