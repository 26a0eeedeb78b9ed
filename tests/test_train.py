"""Whole runs: detector, panel forecast and churn model from prepared rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from telequal.operators import anomaly, churn, split
from telequal.plans import store, train, views
from telequal.session import clear_scratch, durable, scratch_path
from telequal.sources import sinks

DIR = "/root/testdata/sf0.001"


def test_detector_run(spark, tmp_path):
    rng = np.random.default_rng(11)
    x = np.vstack([rng.normal(size=(380, 3)), rng.uniform(-9, 9, size=(20, 3))])
    order = rng.permutation(400)
    pdf = pd.DataFrame(x[order], columns=["a", "b", "c"])
    pdf["y"] = (order >= 380).astype(int)
    pdf["k"] = range(400)
    df = spark.createDataFrame(pdf)
    fit_rows, test = df.where("k < 250"), df.where("k >= 250")
    d = train.fit_detector(fit_rows, ["k"], ("a", "b", "c"), trees=40, sample=64, k=10)
    threshold = anomaly.percentile_threshold(train.detect(fit_rows, d), "ensemble", 0.9)
    scored = train.detect(test, d, threshold)
    assert scored.count() == test.count()
    m = train.evaluate_detector(scored, "y", threshold).first()
    assert m.roc_auc > 0.9 and m.tp + m.fp + m.fn + m.tn == test.count()
    alone = train.detect(test.limit(1), d, threshold).first()
    again = scored.where(F.col("k") == alone.k).first()
    assert abs(alone.ensemble - again.ensemble) < 1e-12  # a single row scores as it does in a batch
    tuned = train.tune_detector(fit_rows, d, "y")
    store.save_detector(d, str(tmp_path / "d"), tuned)
    loaded, kept = store.load_detector(spark.newSession(), str(tmp_path / "d"))
    assert kept == tuned
    asked = test.select("k", F.when(F.col("k") % 7 == 0, "?").otherwise(F.col("a").cast("string")).alias("a"), "b")
    answers = {r.k: r for r in train.score_modem_requests(asked, d, threshold).collect()}
    filled = train.detect(test.withColumn("c", F.lit(0.0)), d, threshold).collect()  # c is left out: its default
    assert len(answers) == len(filled) and list(answers[filled[0].k].asDict()) == ["k", "anomaly_score", "is_anomaly", "threshold", "severity", "error"]
    for r in filled:
        got = answers[r.k]
        if r.k % 7 == 0:
            assert got.error == "a is not a valid number" and got.anomaly_score is None and got.is_anomaly is None
        else:
            assert abs(got.anomaly_score - r.ensemble) < 1e-4 and (got.severity, got.is_anomaly) == (r.severity, r.is_anomaly)
    both = train.detect(test, loaded).select("k", F.col("ensemble").alias("e")).join(scored, "k")
    assert both.where("abs(e - ensemble) < 1e-12").count() == test.count()
    store.write_detector_outputs(scored, train.evaluate_detector(scored, "y", threshold), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "predictions")).count() == test.count()


def test_panel_run(spark, tmp_path):
    run = train.forecast_panel(views.tele(spark, "/root/testdata/sf0.01"), "kind", "ts", "signal")
    assert run.fit.count() == 5
    better = run.errors.join(run.naive_errors.select("series", F.col("rmse").alias("naive")), "series")
    assert better.where("rmse < naive").count() == 5
    assert run.stationarity.where("is_stationary").count() == 5
    assert run.residuals.count() == 5
    store.save_forecast(run, str(tmp_path / "f"))
    assert store.load_forecast(spark, str(tmp_path / "f")).fit.count() == 5


def test_churn_run_and_explanation(spark, tmp_path):
    parts = durable(split.stratified_split(views.crm(spark, DIR), "churn", split.mix(F.col("customer_id"))))
    run = train.train_churn(parts, "logistic", 30)
    got = {r.metric: r.value for r in run.metrics.collect()}
    assert got["roc_auc"] > 0.8
    rows = parts.where("split = 'test'").limit(5)
    shares = train.explain_churn(run, rows, parts.where("split = 'train'"), 4)
    assert shares.count() == 5 * 12
    gap = shares.groupBy("customer_id").agg(F.sum("attribution").alias("t")).join(
        churn.churn_probability(rows, run.model), "customer_id"
    )
    base = gap.select((F.col("churn_prob") - F.col("t")).alias("g")).toPandas()["g"]
    assert np.allclose(base, base.iloc[0], atol=1e-9)
    store.save_churn(run, str(tmp_path / "c"))
    model, threshold = store.load_churn(spark.newSession(), str(tmp_path / "c"))
    assert threshold == run.threshold
    again = churn.churn_probability(run.predictions.drop("churn_prob"), model, "p").select("customer_id", "p")
    assert again.join(run.predictions, "customer_id").where("abs(p - churn_prob) > 1e-12").count() == 0
    store.write_churn_outputs(run, str(tmp_path / "out"), shares)
    assert spark.read.parquet(str(tmp_path / "out" / "importance")).count() == 12


def test_records_keep_missing_values(spark):
    df = spark.sql("select 1 as a, cast(null as double) as b, timestamp'2024-01-01 10:00:00' as t")
    assert sinks.records_json(df).first()[0] == '{"a":1,"b":null,"t":"2024-01-01 10:00:00"}'


def test_scratch_is_cleared(spark):
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    clear_scratch(spark)
    again = durable(spark.range(4))
    assert again.count() == 4
