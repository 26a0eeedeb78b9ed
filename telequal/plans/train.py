"""From prepared rows to fitted detectors, forecasts and the churn model, with their metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telequal.functions.numbers import steady_round
from telequal.functions.rules import severity_band
from telequal.operators import anomaly, churn, evaluate, forecast, neighbours, stats
from telequal.operators.ordered import fitted_row, number
from telequal.operators.requests import completed
from telequal.schemas import CHURN_FEATURES, IF_SAMPLE, IF_TREES, LOF_NEIGHBOURS, MODEM_DEFAULTS, MODEM_FEATURES
from telequal.session import durable


@dataclass(frozen=True)
class Detector:
    """Everything needed to score new readings: all of it fitted on training rows."""

    features: tuple[str, ...]
    scaler: DataFrame
    forest: DataFrame
    density: DataFrame
    limits: DataFrame
    sample: int
    neighbours: int


def _raw_scores(df: DataFrame, d: Detector) -> DataFrame:
    scaled = stats.standardize(df.fillna(0, list(d.features)), d.scaler, d.features, "_z")
    z = [f"{f}_z" for f in d.features]
    both = anomaly.isolation_score(scaled, d.forest, z, sample=d.sample)
    return neighbours.row_lof(both, d.density, z, k=d.neighbours).drop(*z)


def fit_detector(
    train: DataFrame,
    keys: Sequence[str],
    features: Sequence[str] = tuple(MODEM_FEATURES),
    trees: int = IF_TREES,
    sample: int = IF_SAMPLE,
    k: int = LOF_NEIGHBOURS,
) -> Detector:
    rows = train.fillna(0, list(features))
    scaler = durable(stats.fit_standardizer(rows, features))
    z = [f"{f}_z" for f in features]
    scaled = durable(stats.standardize(rows, scaler, features, "_z").select(*keys, *z))
    forest = anomaly.fit_isolation_forest(scaled, z, keys, trees, sample)
    density = neighbours.fit_row_lof(scaled, z, k)
    d = Detector(tuple(features), scaler, forest, density, scaler, sample, k)
    limits = durable(anomaly.fit_ensemble(_raw_scores(train, d)))
    return Detector(d.features, scaler, forest, density, limits, sample, k)


def detect(df: DataFrame, d: Detector, threshold: float | None = None) -> DataFrame:
    """Add if_score, lof and ensemble; with a threshold also is_anomaly and severity."""
    scored = anomaly.ensemble_score(_raw_scores(df, d), d.limits)
    if threshold is None:
        return scored
    return scored.withColumns(
        {
            "is_anomaly": anomaly.decide(F.col("ensemble"), threshold),
            "severity": severity_band(F.col("ensemble"), threshold),
        }
    )


def score_modem_requests(requests: DataFrame, d: Detector, threshold: float) -> DataFrame:
    """Score, decision and severity of each reading; absent fields get the defaults of a normal modem.

    Columns: those of ``requests`` that are no fields, then ``anomaly_score``, ``is_anomaly``, ``threshold``, ``severity`` and
    ``error``; a request with an error has nulls.
    """
    defaults = {f: MODEM_DEFAULTS.get(f, 0.0) for f in d.features}
    full = completed(requests, defaults)
    ok = F.col("error").isNull()
    judged = detect(full, d, threshold)
    return judged.select(
        *[c for c in requests.columns if c not in defaults],
        F.when(ok, steady_round(F.col("ensemble"), 4)).alias("anomaly_score"),
        F.when(ok, F.col("is_anomaly")).alias("is_anomaly"),
        F.lit(round(threshold, 4)).alias("threshold"),
        F.when(ok, F.col("severity")).alias("severity"),
        "error",
    )


def tune_detector(validation: DataFrame, d: Detector, label: str) -> float:
    """The ensemble threshold of best F1 on labelled validation rows (never on test rows)."""
    scored = durable(detect(validation, d).select(label, "ensemble"))
    return float(evaluate.best_f1_threshold(evaluate.pr_curve(scored, label, "ensemble")).first()["threshold"])


def evaluate_detector(scored: DataFrame, label: str, threshold: float) -> DataFrame:
    """One row: auc, precision, recall, f1, confusion counts and the threshold."""
    scored = durable(scored.select(label, "ensemble"))
    auc = fitted_row(evaluate.roc_auc(scored, label, "ensemble"))["auc"]
    counts = evaluate.confusion_metrics(scored, label, F.col("ensemble") > F.lit(threshold))
    return counts.withColumns({"roc_auc": number(auc), "threshold": number(threshold)})


def detector_importance(test: DataFrame, d: Detector, keys: Sequence[str], label: str) -> DataFrame:
    rows = test.select(*keys, label, *d.features)
    return anomaly.permutation_importance(rows, d.features, keys, label, lambda x: detect(x, d), "ensemble")


@dataclass(frozen=True)
class PanelForecast:
    fit: DataFrame
    forecasts: DataFrame
    stationarity: DataFrame
    residuals: DataFrame
    errors: DataFrame
    naive_errors: DataFrame


def forecast_panel(readings: DataFrame, series: str, ts: str, value: str) -> PanelForecast:
    """Hourly model of every series, with stationarity, residual tests and error on the last fifth."""
    panel = durable(forecast.hour_grid(readings, series, ts, value))
    frame = durable(forecast.seasonal_frame(panel))
    fit = durable(forecast.panel_sar_fit(frame))
    made = durable(forecast.panel_sar_forecast(frame, fit))
    left = made.where("train").select("series", "ts", (F.col("actual") - F.col("forecast")).alias("e"))
    return PanelForecast(
        fit,
        made,
        forecast.df_stationarity(panel),
        forecast.ljung_box(left),
        evaluate.forecast_error(made.where("not train"), keys=["series"]),
        forecast.seasonal_naive_error(frame),
    )


@dataclass(frozen=True)
class ChurnRun:
    model: churn.ChurnModel
    threshold: float
    predictions: DataFrame
    metrics: DataFrame


def train_churn(parts: DataFrame, kind: str = "mlp", max_iter: int = 100) -> ChurnRun:
    """Fit on train, tune on validation, predict and measure on test."""
    model = churn.fit_churn(parts.where("split = 'train'"), kind, max_iter)
    threshold = churn.tune_threshold(churn.churn_probability(parts.where("split = 'val'"), model))
    test = durable(churn.churn_probability(parts.where("split = 'test'"), model))
    called = test.withColumn("churn_pred", F.when(F.col("churn_prob") > threshold, 1).otherwise(0))
    return ChurnRun(model, threshold, called, churn.evaluate_churn(test, threshold))


def explain_churn(run: ChurnRun, rows: DataFrame, background: DataFrame, permutations: int = 20) -> DataFrame:
    """Sampled attribution of the model's probability, (customer_id, feature, attribution)."""
    return churn.sampled_attribution(
        rows,
        background,
        CHURN_FEATURES,
        "customer_id",
        lambda d: churn.churn_probability(d, run.model, "_score"),
        "_score",
        permutations,
    )
