"""Least squares by sweeps, the moving-average model and the augmented unit-root test against numpy and plain loops."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from telequal.operators import forecast, leastsq

START = datetime(2024, 1, 1)


def panel(spark, series: dict[str, np.ndarray]):
    rows = [(k, START + timedelta(hours=i), float(v)) for k, y in series.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "series string, ts timestamp, y double")


def simulated(seed: int, n: int, phi: float, season: float, theta: float) -> np.ndarray:
    rng = np.random.default_rng(seed)
    e, z, y = rng.normal(size=n), np.zeros(n), np.zeros(n)
    for t in range(n):
        z[t] = (phi * z[t - 1] if t else 0) + (season * z[t - 24] if t >= 24 else 0) + e[t] + (theta * e[t - 1] if t else 0)
        y[t] = z[t] + (y[t - 24] if t >= 24 else 50)
    return y


def test_sweeps_equal_least_squares(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4))
    x[:, 3] = 2 * x[:, 0] - x[:, 1]  # collinear: left out
    y = x[:, :3] @ [1.0, -2.0, 0.5] + rng.normal(size=300)
    rows = [("a", *map(float, r), float(t)) for r, t in zip(x, y)] + [("b", 0.0, 0.0, 0.0, 0.0, 1.0), ("b", 1.0, None, 0.0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, x0 double, x1 double, x2 double, x3 double, y double")
    solved = leastsq.solve(leastsq.cross_moments(df, ["g"], ["x0", "x1", "x2", "x3", "y"]), 5)
    m = F.col("solved")
    got = {
        r["g"]: r
        for r in solved.select("g", "n", *[leastsq.coefficient(m, 5, k).alias(f"b{k}") for k in range(4)], leastsq.squared_error(m, 5).alias("sse")).collect()
    }
    want, sse, *_ = np.linalg.lstsq(x[:, :3], y, rcond=None)
    assert [got["a"][f"b{k}"] for k in range(4)] == pytest.approx([*want, 0.0])
    assert got["a"]["sse"] == pytest.approx(sse[0])
    assert got["b"]["n"] == 1 and [got["b"][f"b{k}"] for k in range(4)] == [0.0] * 4 and got["b"]["sse"] == 1.0


@pytest.fixture(scope="module")
def moving(spark):
    truth = {"a": (0.6, -0.3, 0.5), "b": (0.3, 0.2, -0.6)}
    return truth, forecast.seasonal_frame(panel(spark, {k: simulated(i, 1500, *v) for i, (k, v) in enumerate(truth.items())})).cache()


def test_moving_average_is_recovered_and_lowers_aic(moving):
    truth, frame = moving
    fit = {r["series"]: r for r in forecast.panel_sarma_fit(frame).collect()}
    plain = {r["series"]: r for r in forecast.panel_sar_fit(frame).collect()}
    for k, want in truth.items():
        assert [fit[k][c] for c in ("phi", "phi_season", "theta")] == pytest.approx(want, abs=0.12)
        assert fit[k]["n"] == plain[k]["n"] and fit[k]["aic"] < plain[k]["aic"] - 20
        assert fit[k]["sigma2"] == pytest.approx(1.0, abs=0.15)


@pytest.mark.parametrize("chunk", [7, 256])
def test_forecasts_carry_errors(spark, moving, monkeypatch, chunk):
    monkeypatch.setattr(forecast, "SCAN_CHUNK", chunk)
    _, frame = moving
    fitted = forecast.panel_sarma_fit(frame)
    fit = {r["series"]: r for r in fitted.collect()}
    got = forecast.panel_sarma_forecast(frame, fitted).toPandas().sort_values(["series", "ts"])
    ahead = forecast.panel_sarma_horizon(frame, fitted, 60).toPandas().sort_values(["series", "step"])
    for k, rows in frame.toPandas().sort_values("ts").groupby("series"):
        f, y = fit[k], rows["y"].to_numpy()
        z = np.concatenate((np.full(24, np.nan), y[24:] - y[:-24]))
        e, want, last = 0.0, [], None
        for t in range(48, len(y)):
            at = y[t - 24] + f["phi"] * z[t - 1] + f["phi_season"] * z[t - 24] + f["theta"] * e
            e = y[t] - at
            want.append(at)
            if rows["train"].iloc[t]:
                last = e
        mine = got[got["series"] == k]
        assert mine["forecast"].to_numpy() == pytest.approx(want)
        assert mine["train"].tolist() == rows["train"].tolist()[48:]
        path = y[: int(rows["train"].sum())].tolist()
        n = len(path)
        for s in range(60):
            t = len(path)
            add = f["theta"] * last if s == 0 else 0.0
            path.append(path[t - 24] + f["phi"] * (path[t - 1] - path[t - 25]) + f["phi_season"] * (path[t - 24] - path[t - 48]) + add)
        assert ahead[ahead["series"] == k]["forecast"].to_numpy() == pytest.approx(path[n:])


def test_series_without_history(spark):
    frame = forecast.seasonal_frame(panel(spark, {"short": np.arange(30.0), "flat": np.full(200, 5.0), "one": np.ones(1)}))
    fitted = forecast.panel_sarma_fit(frame)
    fit = {r["series"]: r for r in fitted.collect()}
    assert fit["short"]["phi"] is None and fit["short"]["reason"] == "too little history" and fit["one"]["n"] == 0
    assert fit["flat"]["theta"] == 0.0 and fit["flat"]["aic"] is None
    rows = forecast.panel_sarma_forecast(frame, fitted).toPandas().sort_values(["series", "ts"])
    assert rows[rows["series"] == "flat"]["forecast"].eq(5.0).all()
    assert rows[rows["series"] == "short"]["forecast"].dropna().tolist() == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    assert forecast.panel_sarma_horizon(frame, fitted, 3).where("series = 'flat'").toPandas()["forecast"].tolist() == [5.0] * 3
    assert forecast.panel_sarma_fit(frame.limit(0)).count() == 0


def nested_adf(y: np.ndarray, most: int):
    d = np.diff(y)
    at = np.arange(most, len(d))
    full = np.column_stack([np.ones(len(at)), y[at], *[d[at - k] for k in range(1, most + 1)]])
    models = []
    for k in range(most + 1):
        x, n = full[:, : 2 + k], len(at)
        b = np.linalg.lstsq(x, d[at], rcond=None)[0]
        sse = ((d[at] - x @ b) ** 2).sum()
        se = np.sqrt(sse / (n - 2 - k) * np.linalg.inv(x.T @ x)[1, 1])
        models.append((n * (np.log(2 * np.pi * sse / n) + 1) + 2 * (2 + k), k, b[1] / se))
    return min(models)


def test_augmented_test_equals_nested_regressions(spark):
    rng = np.random.default_rng(3)
    walk = np.cumsum(rng.normal(size=600))
    ar = np.zeros(600)
    for t in range(3, 600):
        ar[t] = 0.5 * ar[t - 1] - 0.4 * ar[t - 3] + rng.normal()
    series = {"walk": walk, "ar": ar + 20, "flat": np.full(100, 3.0), "short": np.arange(8.0), "line": np.arange(80.0)}
    got = {r["series"]: r for r in forecast.adf_stationarity(panel(spark, series)).collect()}
    for k in ("walk", "ar"):
        aic, lags, statistic = nested_adf(series[k], 12)
        assert (got[k]["lags"], got[k]["n"]) == (lags, 600 - 13)
        assert (got[k]["aic"], got[k]["statistic"]) == pytest.approx((aic, statistic))
    assert got["ar"]["is_stationary"] and got["ar"]["lags"] >= 2 and not got["walk"]["is_stationary"]
    assert all(got[k]["statistic"] is None and got[k]["p_value"] is None for k in ("flat", "short"))
    assert set(got) == set(series)


def test_p_values_follow_the_table(spark):
    points = [-9.0, -3.43, -2.86, -2.57, -2.715, 0.6, 5.0, None]
    df = spark.createDataFrame([(x,) for x in points], "t double").select(forecast.unit_root_p(F.col("t")).alias("p"))
    assert df.toPandas()["p"].tolist()[:7] == pytest.approx([0.01, 0.01, 0.05, 0.10, 0.075, 0.99, 0.99])
    assert pd.isna(df.toPandas()["p"].iloc[7])
