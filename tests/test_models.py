"""Forest, ensemble, importance, churn model, attribution, preparation and sinks."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from telequal.operators import anomaly, churn, evaluate, network, split, stats
from telequal.plans import prepare, store, views
from telequal.plans import train as train_plans
from telequal.schemas import MODEM_FEATURES
from telequal.session import durable
from telequal.sources import sinks, tables

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(size=(950, 2)), rng.uniform(-8, 8, size=(50, 2))])
    pdf = pd.DataFrame({"id": range(1000), "a": x[:, 0], "b": x[:, 1], "y": [0] * 950 + [1] * 50})
    return spark.createDataFrame(pdf).repartition(4, "id").cache()


def test_forest_finds_scattered_points_and_repeats(blobs):
    model = anomaly.fit_isolation_forest(blobs, ["a", "b"], ["id"], trees=50, sample=128)
    sizes = model.groupBy("tree").count().toPandas()
    assert len(sizes) == 50 and sizes["count"].max() <= 255
    scored = anomaly.isolation_score(blobs, model, ["a", "b"], sample=128)
    assert evaluate.roc_auc(scored, "y", "if_score").first().auc > 0.9
    again = anomaly.fit_isolation_forest(blobs.repartition(3), ["a", "b"], ["id"], trees=50, sample=128)
    assert model.exceptAll(again).count() == 0


def test_forest_on_fewer_rows_than_a_sample(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "id int, a double")
    model = anomaly.fit_isolation_forest(df, ["a"], ["id"], trees=8, sample=256)
    assert model.select("tree").distinct().count() == 8
    assert anomaly.isolation_score(df, model, ["a"]).where("if_score between 0 and 1").count() == 10


def test_ensemble_uses_stored_limits(spark):
    train = spark.createDataFrame([(0.2, 1.0), (0.6, 3.0)], "if_score double, lof double")
    limits = anomaly.fit_ensemble(train)
    one = spark.createDataFrame([(0.6, 3.0)], "if_score double, lof double")
    assert anomaly.ensemble_score(one, limits).first().ensemble == pytest.approx(1.0)


def test_permutation_importance_ranks_the_informative_feature(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] > 0).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"id": range(400), "a": x[:, 0], "b": x[:, 1], "y": y}))
    mixed = anomaly.permuted(df, ["a", "b"], ["id"])
    assert mixed.count() == 800
    kept = mixed.where("shuffled = 'b'").select("id", "a", "y")
    assert kept.exceptAll(df.select("id", "a", "y")).count() == 0
    moved = mixed.where("shuffled = 'a'").agg(F.sum("a"), F.count_distinct("a")).first()
    assert moved[0] == pytest.approx(x[:, 0].sum()) and moved[1] == 400
    got = anomaly.permutation_importance(
        df, ["a", "b"], ["id"], "y", lambda d: d.withColumn("s", F.col("a") + F.col("b") * 0.01), "s"
    )
    drop = {r.feature: r["drop"] for r in got.collect()}
    assert drop["a"] > 0.3 and abs(drop["b"]) < 0.05


@pytest.fixture(scope="module")
def customers(spark):
    crm = views.crm(spark, DIR)
    return durable(split.stratified_split(crm, "churn", split.mix(F.col("customer_id"))))


@pytest.fixture(scope="module")
def model(customers):
    return churn.fit_churn(customers.where("split <> 'test'"), "logistic")


def test_linear_model_beats_chance(customers, model):
    test = churn.churn_probability(customers.where("split = 'test'"), model)
    got = {r.metric: r.value for r in churn.evaluate_churn(test, 0.5).collect()}
    assert got["roc_auc"] > 0.8 and got["tn"] + got["fp"] + got["fn"] + got["tp"] == test.count()


def test_network_trains_and_keeps_a_history(customers):
    m = churn.fit_churn(customers.where("split = 'train'"), "mlp", max_iter=15)
    history = churn.training_history(m).orderBy("epoch").collect()
    assert len(history) > 3 and history[-1].loss < history[0].loss
    p = churn.churn_probability(customers.where("split = 'val'"), m)
    assert p.where("churn_prob between 0 and 1").count() == p.count()


def test_scoring_fills_defaults_and_reports_bad_rows(spark, model):
    req = spark.createDataFrame(
        [(1, "12", "Month-to-month"), (2, "many", "One year"), (3, None, "Never seen")],
        "request int, tenure_months string, contract_type string",
    )
    got = {r.request: r for r in churn.score_customers(req, model, 0.4).collect()}
    assert got[1].error is None and 0 <= got[1].churn_probability <= 1
    assert got[2].churn_probability is None and "tenure_months" in got[2].error
    assert got[3].error is None and got[3].retention_action == "Schedule proactive tech support call"
    assert got[1].risk_level in ("High", "Medium", "Low")


def test_linear_attribution_sums_to_score_minus_mean(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 1.0), (3, 8.0, 0.0)], "id int, a double, b double")
    w = spark.createDataFrame([(0.5, -2.0)], "a double, b double")
    fitted = stats.fit_standardizer(df, ["a", "b"])
    local = churn.linear_attribution(df, w, fitted, ["a", "b"], "id")
    z = stats.standardize(df, fitted, ["a", "b"]).withColumn("s", F.col("a") * 0.5 - F.col("b") * 2.0)
    both = local.groupBy("id").agg(F.sum("attribution").alias("t")).join(z, "id").collect()
    assert all(r.t == pytest.approx(r.s) for r in both)


def test_sampled_attribution_sums_to_prediction_minus_baseline(spark):
    df = spark.range(30).select("id", (F.col("id") * 1.0).alias("a"), F.sqrt("id").alias("b"))
    score = lambda d: d.withColumn("s", F.least(F.col("a") * F.col("b"), F.lit(40.0)))
    local = churn.sampled_attribution(df, df, ["a", "b"], "id", score, "s", permutations=6)
    total = local.groupBy("id").agg(F.sum("attribution").alias("t")).join(score(df), "id")
    gaps = total.select((F.col("s") - F.col("t")).alias("g")).toPandas()["g"]
    assert np.allclose(gaps, gaps.iloc[0])


def test_sampled_attribution_walks_every_order_from_every_background_row(spark):
    rows = [(i, float(i % 7), float(i * i % 11), float(i % 3)) for i in range(12)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    value = lambda v: min(v[0] * v[1], 20.0) + v[2] * v[0]
    score = lambda d: d.withColumn("s", F.least(F.col("a") * F.col("b"), F.lit(20.0)) + F.col("c") * F.col("a"))
    local = churn.sampled_attribution(df, df, ["a", "b", "c"], "id", score, "s", permutations=5, background_rows=12)
    got = {(r["id"], r["feature"]): r["attribution"] for r in local.collect()}
    rng = np.random.default_rng(42)
    orders = [rng.permutation(3).tolist() for _ in range(5)]
    for i, *x in rows:
        want = [0.0] * 3
        for order in orders:
            for _, *at in rows:
                for f in order:
                    before = value(at)
                    at[f] = x[f]
                    want[f] += (value(at) - before) / 60
        assert [got[i, f] for f in "abc"] == pytest.approx(want, abs=1e-9)


def _modems(spark):
    rng = np.random.default_rng(8)
    n = 400
    base = pd.DataFrame(rng.normal(size=(n, 9)), columns=MODEM_FEATURES[:9])
    base[["ds_power_level_dbmv"]] *= 3
    base["us_power_level_dbmv"] += 42
    base["ds_snr_db"] += 38
    base["us_mer_db"] += 36
    base[["ds_channel_utilization_pct", "us_channel_utilization_pct"]] += 50
    base.loc[5, "ds_snr_db"] = -999.0
    base.loc[6, "us_mer_db"] = np.nan
    base.loc[8, "ds_power_level_dbmv"] = 14.9
    base["timestamp"] = pd.date_range("2024-01-01", periods=n // 4, freq="15min").repeat(4)
    base["modem_id"] = [f"MDM-{i % 4:04d}" for i in range(n)]
    base["customer_id"] = base["modem_id"].str.replace("MDM", "CUS")
    base["channel_util_peak_hour_flag"] = 0
    base["anomaly_flag"] = (rng.random(n) < 0.1).astype(int)
    return spark.createDataFrame(pd.concat([base, base.iloc[40:70]], ignore_index=True)), n


@pytest.mark.parametrize("limit", [10**6, 30])
def test_modem_preparation(spark, limit):
    raw, n = _modems(spark)
    parts, report = prepare.prepare_modems(raw, max_entity_rows=limit)
    assert parts.count() == n
    nulls = parts.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in parts.columns]).first()
    assert sum(nulls) == 0
    edge = parts.groupBy("split").agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).collect()
    at = {r.split: r for r in edge}
    assert at["train"].hi < at["test"].lo
    first = parts.where("timestamp = '2024-01-01'")
    assert first.where("ds_power_rolling_std_1h <> 0 or snr_drop_rate_per_hour <> 0").count() == 0
    got = {(r.step, r.column, r.metric): r.value for r in report.collect()}
    assert got[("range", "ds_snr_db", "n_bad")] == 1
    assert got[("dedup", "all", "exact_rows")] == 30 and got[("dedup", "all", "rows_after")] == n
    assert got[("split", "train", "n_rows")] + got[("split", "test", "n_rows")] == n


def test_wifi_preparation(spark):
    rng = np.random.default_rng(9)
    n = 200
    pdf = pd.DataFrame(
        {
            "timestamp": pd.date_range("2024-01-01", periods=n, freq="h"),
            "customer_id": "CUS-0000",
            "device_id": "CUS-0000-LAP-01",
            "device_type": ["laptop"] * (n - 1) + ["fridge"],
            "hour_of_day": 0,
            "day_of_week": 0,
            "wifi_experience_score": rng.normal(75, 5, n),
            "rssi_dbm": rng.normal(-55, 5, n),
            "channel_interference_pct": rng.normal(15, 2, n),
            "active_device_count": rng.integers(1, 6, n),
            "experience_rolling_mean_7d": 0.0,
            "experience_rolling_std_7d": 0.0,
            "hfc_anomaly_flag": 0,
            "forecast_breach_flag": 0,
        }
    )
    pdf.loc[3, "wifi_experience_score"] = 150.0
    parts, report = prepare.prepare_wifi(spark.createDataFrame(pdf))
    rows = parts.orderBy("timestamp").collect()
    assert len(rows) == n
    assert rows[3].wifi_experience_score == rows[2].wifi_experience_score
    assert rows[5].experience_rolling_mean_7d == rows[5].wifi_experience_score
    assert rows[5].experience_rolling_std_7d == 1.0 and rows[30].experience_rolling_std_7d != 1.0
    assert rows[-1].device_type_encoded == -1 and rows[0].device_type_encoded == 0
    assert rows[20].hour_of_day == 20 and rows[20].is_peak_hour == 1
    assert report.where("step = 'cap'").count() == 4 * 3


def test_customer_preparation(spark):
    crm = views.crm(spark, DIR).withColumn("customer_id", F.col("customer_id").cast("string"))
    bad = crm.limit(1).withColumn("contract_type", F.lit("weekly")).withColumn("customer_id", F.lit("bad"))
    parts, report = prepare.prepare_customers(crm.unionByName(bad).unionByName(crm))
    assert parts.count() == crm.count()
    got = {(r.step, r.column, r.metric): r.value for r in report.collect()}
    assert got[("rule", "contract_type", "n_bad")] == 1
    assert got[("dedup", "all", "exact_rows")] == crm.count()


def test_report_metrics_and_csv_files(spark, tmp_path):
    rows = [
        {"name": "top", "threshold": 0.4, "roc_auc": 0.7, "f1": 0.5},
        {"name": "nested", "threshold": {"value": 0.2}, "evaluation": {"roc_auc": 0.8, "avg_prec": 0.3}},
    ]
    src = tmp_path / "m.json"
    src.write_text("\n".join(json.dumps(r) for r in rows))
    got = {r.name: r for r in tables.read_metrics(spark, str(src)).collect()}
    assert (got["top"].threshold, got["top"].roc_auc, got["top"].f1, got["top"].recall) == (0.4, 0.7, 0.5, 0.0)
    assert (got["nested"].threshold, got["nested"].roc_auc, got["nested"].avg_prec) == (0.2, 0.8, 0.3)
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "k string, v double")
    for _ in range(2):
        sinks.write_csv(df, str(tmp_path / "csv"))
        sinks.write_parquet(df, str(tmp_path / "pq"))
        sinks.write_report(df, str(tmp_path / "js"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 2
    assert spark.read.json(str(tmp_path / "js")).count() == 2


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(0)
    sizes, x, y = (3, 5, 4, 1), rng.normal(size=(20, 3)), rng.integers(0, 2, 20).astype(float)
    flat, weight = network.initial(sizes, 1), rng.uniform(0.5, 2, 20)
    loss, grad = network.gradient(flat, sizes, x, y, weight)
    for i in rng.choice(len(flat), 25, replace=False):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        up, down = (network.gradient(flat + d, sizes, x, y, weight)[0] for d in (step, -step))
        assert grad[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_binned_auc_counts_ties_half():
    counts = np.zeros((2, 4), np.int64)
    counts[0, [0, 1]], counts[1, [1, 3]] = [2, 1], [1, 1]
    assert network.binned_auc(counts) == pytest.approx((2 + 0.5 + 3) / 6)
    assert network.binned_auc(np.zeros((2, 4), np.int64)) == 0.5


def curved(spark, n=3000):
    """A label no linear model can tell: inside or outside a ring."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 2))
    y = (np.abs(np.hypot(*x.T) - 1.2) < 0.45).astype(int)
    return spark.createDataFrame(pd.DataFrame({"id": range(n), "a": x[:, 0], "b": x[:, 1], "y": y})).repartition(3)


@pytest.mark.parametrize(("rows_per_task", "batch", "margin"), [(10_000, 32, 0.3), (150, 8, 0.2)])
def test_network_learns_what_a_line_cannot(spark, monkeypatch, rows_per_task, batch, margin):
    monkeypatch.setattr(network, "ROWS_PER_TASK", rows_per_task)
    df = curved(spark)
    x = F.array("a", "b")
    fitted = network.fit_network(df.where("id % 5 > 0"), x, "y", ["id"], [16, 8], epochs=25, patience=25, rate=0.01, batch_rows=batch)
    test = df.where("id % 5 = 0").withColumn("p", network.probability(fitted, x, spark))
    line = df.where("id % 5 = 0").withColumn("p", F.col("a") + F.col("b"))
    assert evaluate.roc_auc(test, "y", "p").first().auc > evaluate.roc_auc(line, "y", "p").first().auc + margin
    assert fitted.history[-1][1] < fitted.history[0][1] and len(fitted.history) == 25
    again = network.fit_network(df.where("id % 5 > 0").repartition(2), x, "y", ["id"], [16, 8], epochs=2, patience=25, rate=0.01, batch_rows=batch)
    assert [h[1] for h in again.history] == pytest.approx([h[1] for h in fitted.history[:2]])


def test_network_stops_early_and_needs_both_classes(spark):
    rng = np.random.default_rng(4)
    noise = spark.createDataFrame(pd.DataFrame({"id": range(400), "a": rng.normal(size=400), "y": rng.integers(0, 2, 400)}))
    fitted = network.fit_network(noise, F.array("a"), "y", ["id"], [4], epochs=60, patience=3)
    best = max(range(len(fitted.history)), key=lambda i: fitted.history[i][2])
    assert len(fitted.history) < 60 and len(fitted.history) - 1 - best == 3
    missing = noise.withColumn("p", network.probability(fitted, F.array(F.lit(None).cast("double")), spark))
    assert missing.where("p IS NULL").count() == 400
    with pytest.raises(ValueError, match="both classes"):
        network.fit_network(noise.where("y = 1"), F.array("a"), "y", ["id"], [4])


def test_churn_network_beats_the_line(spark, customers, tmp_path):
    train, test = customers.where("split <> 'test'"), customers.where("split = 'test'")
    m = churn.fit_churn(train, "network", max_iter=40)
    auc = lambda x: evaluate.roc_auc(churn.churn_probability(test, x), "churn", "churn_prob").first().auc
    history = churn.training_history(m).orderBy("epoch").collect()
    assert history[-1].loss < history[0].loss and max(h.val_score for h in history) > 0.85
    assert auc(m) > 0.85
    run = train_plans.ChurnRun(m, 0.5, test, test)
    store.save_churn(run, str(tmp_path / "n"))
    loaded, threshold = store.load_churn(spark, str(tmp_path / "n"))
    assert threshold == 0.5 and auc(loaded) == pytest.approx(auc(m))
