"""Save fitted models below a folder and load them in another session."""

from __future__ import annotations

import json
from dataclasses import fields

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from telequal.operators import churn
from telequal.operators.network import Network
from telequal.plans.train import ChurnRun, Detector, PanelForecast


def _write_settings(spark: SparkSession, folder: str, values: dict) -> None:
    spark.createDataFrame([(json.dumps(values),)], "settings string").coalesce(1).write.mode("overwrite").text(f"{folder}/settings")


def _read_settings(spark: SparkSession, folder: str) -> dict:
    return json.loads(spark.read.text(f"{folder}/settings").first()[0])


def save_detector(d: Detector, folder: str, threshold: float | None = None) -> None:
    """All fitted tables and settings of a detector, with the threshold to use, if one was tuned."""
    for name in ("scaler", "forest", "density", "limits"):
        getattr(d, name).write.mode("overwrite").parquet(f"{folder}/{name}")
    settings = {"features": list(d.features), "sample": d.sample, "neighbours": d.neighbours, "threshold": threshold}
    _write_settings(d.scaler.sparkSession, folder, settings)


def load_detector(spark: SparkSession, folder: str) -> tuple[Detector, float | None]:
    s = _read_settings(spark, folder)
    tables = {name: spark.read.parquet(f"{folder}/{name}") for name in ("scaler", "forest", "density", "limits")}
    return Detector(tuple(s["features"]), sample=s["sample"], neighbours=s["neighbours"], **tables), s["threshold"]


def save_churn(run: ChurnRun, folder: str) -> None:
    """The churn model with its codes, scaling and threshold."""
    run.model.codes.write.mode("overwrite").parquet(f"{folder}/codes")
    run.model.scaler.write.mode("overwrite").parquet(f"{folder}/scaler")
    m, settings = run.model.classifier, {"threshold": run.threshold}
    if isinstance(m, Network):
        settings |= {"sizes": list(m.sizes), "weights": m.weights.tolist(), "history": [list(h) for h in m.history]}
    else:
        PipelineModel([m]).write().overwrite().save(f"{folder}/classifier")
    _write_settings(run.model.scaler.sparkSession, folder, settings)


def load_churn(spark: SparkSession, folder: str) -> tuple[churn.ChurnModel, float]:
    s = _read_settings(spark, folder)
    if "weights" in s:
        classifier = Network(tuple(s["sizes"]), np.array(s["weights"]), tuple(tuple(h) for h in s["history"]))
    else:
        classifier = PipelineModel.load(f"{folder}/classifier").stages[0]
    codes, scaler = (spark.read.parquet(f"{folder}/{t}") for t in ("codes", "scaler"))
    return churn.ChurnModel(codes, scaler, classifier), s["threshold"]


def save_forecast(panel: PanelForecast, folder: str) -> None:
    """Every table of a panel's forecast: fits, forecasts, tests and errors."""
    for f in fields(panel):
        getattr(panel, f.name).write.mode("overwrite").parquet(f"{folder}/{f.name}")


def load_forecast(spark: SparkSession, folder: str) -> PanelForecast:
    return PanelForecast(**{f.name: spark.read.parquet(f"{folder}/{f.name}") for f in fields(PanelForecast)})


def write_churn_outputs(run: ChurnRun, folder: str, attributions: DataFrame | None = None) -> None:
    """What a training run leaves for others: predictions, metrics, learning curve and attributions."""
    run.predictions.write.mode("overwrite").parquet(f"{folder}/predictions")
    run.metrics.write.mode("overwrite").json(f"{folder}/metrics")
    churn.training_history(run.model).write.mode("overwrite").parquet(f"{folder}/history")
    if attributions is not None:
        attributions.write.mode("overwrite").parquet(f"{folder}/attributions")
        churn.attribution_global(attributions).write.mode("overwrite").parquet(f"{folder}/importance")


def write_detector_outputs(scored: DataFrame, metrics: DataFrame, folder: str, importance: DataFrame | None = None) -> None:
    """Scored rows, metrics and importances of a detector."""
    scored.write.mode("overwrite").parquet(f"{folder}/predictions")
    metrics.write.mode("overwrite").json(f"{folder}/metrics")
    if importance is not None:
        importance.write.mode("overwrite").parquet(f"{folder}/importance")
