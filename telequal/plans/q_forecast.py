"""Queries: the hourly panel, its models, residuals and forecast quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telequal.operators import features, forecast
from telequal.operators.evaluate import forecast_error as error_metrics
from telequal.operators.panel import measure
from telequal.plans import views
from telequal.plans.q_statistics import _confusion
from telequal.plans.registry import VIEWS, query, r, sql


def _frame(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.seasonal_frame(views.hourly(spark, folder))


def _forecasts(spark: SparkSession, folder: str) -> DataFrame:
    frame = _frame(spark, folder)
    return forecast.panel_sar_forecast(frame, forecast.panel_sar_fit(frame))


_STATIONARY = {
    "d": "SELECT series, lag(y) OVER w AS x, y - lag(y) OVER w AS d FROM hourly WINDOW w AS (PARTITION BY series ORDER BY ts)",
    "m": """SELECT series, count(*) AS n, regr_slope(d, x) AS b, regr_sxx(d, x) AS sxx, regr_syy(d, x) AS syy,
                   regr_sxy(d, x) AS sxy FROM d WHERE x IS NOT NULL GROUP BY series""",
}


@query(
    "df_stationarity",
    sql(
        """SELECT series, n, round(b, 6) AS slope, round(b / sqrt((syy - b * sxy) / (n - 2) / sxx), 4) AS statistic,
                  b / sqrt((syy - b * sxy) / (n - 2) / sxx) < -2.86::DOUBLE AS is_stationary FROM m""",
        "hourly",
        **_STATIONARY,
    ),
)
def df_stationarity(spark: SparkSession, folder: str) -> DataFrame:
    out = forecast.df_stationarity(views.hourly(spark, folder))
    return out.select("series", "n", r("slope", 6), r("statistic"), "is_stationary")


@query(
    "panel_sar_fit",
    sql(
        """SELECT series, n, round(phi, 6) AS phi, round(phi_season, 6) AS phi_season, round(sigma2, 4) AS sigma2,
                  round(llf, 4) AS llf, round(6 - 2 * llf, 4) AS aic, round(3 * ln(n) - 2 * llf, 4) AS bic FROM fit""",
        "fit",
    ),
)
def panel_sar_fit(spark: SparkSession, folder: str) -> DataFrame:
    fit = forecast.panel_sar_fit(_frame(spark, folder))
    return fit.select(
        "series", "n", r("phi", 6), r("phi_season", 6), *[r(c) for c in ("sigma2", "llf", "aic", "bic")]
    )


@query(
    "panel_sar_forecast",
    sql(
        "SELECT series, ts, train, round(actual, 4) AS actual, round(forecast, 4) AS forecast FROM fcast", "fcast"
    ),
)
def panel_sar_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return _forecasts(spark, folder).select("series", "ts", "train", r("actual"), r("forecast"))


def _recursion(steps: int) -> dict[str, str]:
    """The step-by-step forecast as a recursive query over the last 48 values."""
    return {
        "st": f"""
            SELECT series, 0 AS step, list(y ORDER BY ts) AS ys, any_value(phi) AS a, any_value(phi_season) AS b,
                   max(ts) AS origin
            FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts DESC) AS k FROM sframe WHERE train)
                 JOIN fit USING (series) WHERE k <= 48 GROUP BY series HAVING count(*) = 48
            UNION ALL
            SELECT series, step + 1, list_append(ys[2:48],
                   ys[25] + a * (ys[48] - ys[24]) + b * (ys[25] - ys[1])), a, b, origin
            FROM st WHERE step < {steps}"""
    }


@query(
    "panel_sar_horizon",
    "WITH RECURSIVE"
    + sql(
        """SELECT series, CAST(step AS INTEGER) AS step, origin + step * INTERVAL 1 HOUR AS ts,
                  round(ys[48], 4) AS forecast FROM st WHERE step > 0""",
        "sframe",
        "fit",
        **_recursion(72),
    )[len("WITH") :],
)
def panel_sar_horizon(spark: SparkSession, folder: str) -> DataFrame:
    frame = _frame(spark, folder)
    out = forecast.panel_sar_horizon(frame, forecast.panel_sar_fit(frame), 72)
    return out.select("series", "step", "ts", r("forecast"))


_ERRORS = """count(*) AS n, round(avg(abs(a - f)), 4) AS mae, round(sqrt(avg((a - f) * (a - f))), 4) AS rmse,
             round(avg(abs(a - f) / (abs(a) + 1e-6)) * 100, 4) AS mape"""


@query(
    "seasonal_naive_error",
    sql(
        f"""SELECT series, {_ERRORS} FROM (SELECT series, y AS a, y_season AS f FROM sframe
            WHERE NOT train AND y_season IS NOT NULL) GROUP BY series""",
        "sframe",
    ),
)
def seasonal_naive_error(spark: SparkSession, folder: str) -> DataFrame:
    out = forecast.seasonal_naive_error(_frame(spark, folder))
    return out.select("series", "n", r("mae"), r("rmse"), r("mape"))


@query(
    "forecast_error",
    sql(
        f"""SELECT series, {_ERRORS} FROM (SELECT series, actual AS a, forecast AS f FROM fcast WHERE NOT train)
            GROUP BY series""",
        "fcast",
    ),
)
def forecast_error(spark: SparkSession, folder: str) -> DataFrame:
    out = error_metrics(_forecasts(spark, folder).where("not train"), keys=["series"])
    return out.select("series", "n", r("mae"), r("rmse"), r("mape"))


def _lb_sql() -> str:
    lags = ", ".join(f"sum(c * l{k}) AS s{k}" for k in range(1, 21))

    def q(upto: int) -> str:
        return "n * (n + 2) * (" + " + ".join(f"(s{k} / s0) ** 2 / (n - {k})" for k in range(1, upto + 1)) + ")"

    def tail(x: str, dof: int) -> str:
        terms = " + ".join(f"({x} / 2) ** {i} / factorial({i})" for i in range(dof // 2))
        return f"exp(-{x} / 2) * ({terms})"

    return sql(
        f"""SELECT series, n, round(residual_mean, 4) AS residual_mean, round(residual_std, 4) AS residual_std,
                   round(q10, 4) AS q10, round({tail('q10', 10)}, 6) AS p10, round(q20, 4) AS q20,
                   round({tail('q20', 20)}, 6) AS p20,
                   ({tail('q10', 10)} > 0.05::DOUBLE AND {tail('q20', 20)} > 0.05::DOUBLE) AS white_noise
            FROM (SELECT *, {q(10)} AS q10, {q(20)} AS q20 FROM m)""",
        "fcast",
        e="SELECT series, ts, actual - forecast AS e FROM fcast WHERE train",
        c0="SELECT series, ts, e, e - avg(e) OVER (PARTITION BY series) AS c FROM e",
        c1="SELECT *, "
        + ", ".join(f"lag(c, {k}) OVER w AS l{k}" for k in range(1, 21))
        + " FROM c0 WINDOW w AS (PARTITION BY series ORDER BY ts)",
        m=f"SELECT series, count(*) AS n, avg(e) AS residual_mean, stddev_samp(e) AS residual_std, sum(c * c) AS s0, {lags} FROM c1 GROUP BY series",
    )


@query("ljung_box", _lb_sql())
def ljung_box(spark: SparkSession, folder: str) -> DataFrame:
    e = _forecasts(spark, folder).where("train").select(
        "series", "ts", (F.col("actual") - F.col("forecast")).alias("e")
    )
    out = forecast.ljung_box(e)
    return out.select(
        "series",
        "n",
        r("residual_mean"),
        r("residual_std"),
        r("q10"),
        r("p10", 6),
        r("q20"),
        r("p20", 6),
        "white_noise",
    )


_HW = "(PARTITION BY series ORDER BY ts ROWS BETWEEN 167 PRECEDING AND CURRENT ROW)"


@query(
    "forecast_breach_eval",
    sql(
        _confusion("j", "breach", "called", "series"),
        "fcast",
        base=f"""SELECT series, ts, CASE WHEN count(y) OVER {_HW} >= 24 THEN avg(y) OVER {_HW} ELSE y END AS m,
                        CASE WHEN count(y) OVER {_HW} >= 24 THEN stddev_samp(y) OVER {_HW} ELSE 1 END AS s FROM hourly""",
        j="""SELECT series, CASE WHEN actual < m - s THEN 1 ELSE 0 END AS breach, forecast < m - s AS called
             FROM fcast JOIN base USING (series, ts) WHERE NOT train""",
    ),
)
def forecast_breach_eval(spark: SparkSession, folder: str) -> DataFrame:
    panel = views.hourly(spark, folder)
    base = features.rolling_baseline(panel, measure(panel, "series", ("ts",)), "y")
    out = forecast.forecast_breach_eval(_forecasts(spark, folder), base.drop("y"), sigmas=1.0)
    return out.select("series", "tn", "fp", "fn", "tp", *[r(c, 6) for c in ("precision", "recall", "f1")])


@query(
    "forecast_sample",
    sql(
        """SELECT series, ts, round(actual, 4) AS actual, round(forecast, 4) AS forecast,
                  round(m - 3 * s, 4) AS lower_bound, CASE WHEN forecast < m - 3 * s THEN 1 ELSE 0 END AS breach_pred,
                  CASE WHEN actual < m - 3 * s THEN 1 ELSE 0 END AS breach_actual
           FROM fcast JOIN base USING (series, ts) WHERE NOT train""",
        "fcast",
        base=f"""SELECT series, ts, CASE WHEN count(y) OVER {_HW} >= 24 THEN avg(y) OVER {_HW} ELSE y END AS m,
                        CASE WHEN count(y) OVER {_HW} >= 24 THEN stddev_samp(y) OVER {_HW} ELSE 1 END AS s FROM hourly""",
    ),
)
def forecast_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The table kept for plots: actual, forecast, bound and both breach flags."""
    panel = views.hourly(spark, folder)
    base = features.rolling_baseline(panel, measure(panel, "series", ("ts",)), "y").drop("y")
    bound = features.lower_bound()
    joined = _forecasts(spark, folder).where("not train").join(base, ["series", "ts"])
    return joined.select(
        "series",
        "ts",
        r("actual"),
        r("forecast"),
        r(bound, 4, "lower_bound"),
        F.when(F.col("forecast") < bound, 1).otherwise(0).alias("breach_pred"),
        F.when(F.col("actual") < bound, 1).otherwise(0).alias("breach_actual"),
    )


def _recursive(text: str) -> str:
    return "WITH RECURSIVE" + text[len("WITH") :]


def _swept_sql(name: str, moments: str, size: int) -> str:
    """``moments`` (series, n, m) with columns 0 to size - 2 swept one after the other: a row per step k."""
    at = lambda i, j: f"m[{i} * {size} + {j} + 1]"
    d = at("k", "k")
    i, j = f"(t // {size})", f"(t % {size})"
    put_in = f"""CASE WHEN {i} = k AND {j} = k THEN 1 / {d} WHEN {i} = k THEN m[t + 1] / {d}
                      WHEN {j} = k THEN -m[t + 1] / {d} ELSE m[t + 1] - {at(i, 'k')} * {at('k', j)} / {d} END"""
    leave_out = f"CASE WHEN {i} = k OR {j} = k THEN 0::DOUBLE ELSE m[t + 1] END"
    return f"""
        SELECT series, n, 0 AS k, m, m AS m0 FROM {moments}
        UNION ALL
        SELECT series, n, k + 1, CASE WHEN {d} > m0[k * {size} + k + 1] * 1e-10::DOUBLE
                   THEN list_transform(range({size * size}), lambda t: {put_in})
                   ELSE list_transform(range({size * size}), lambda t: {leave_out}) END, m0
        FROM {name} WHERE k < {size - 1}"""


def _moments_sql(source: str, columns: list[str], where: str = "true") -> str:
    cells = ", ".join(f"CAST(sum({a} * {b}) AS DOUBLE)" for a in columns for b in columns)
    known = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return f"SELECT series, count(*) AS n, [{cells}] AS m FROM {source} WHERE {where} AND {known} GROUP BY series"


def _adf_sql(panel: str) -> str:
    lags = range(1, forecast.MOST_ADF_LAGS + 1)
    columns = ["1::DOUBLE", "x", *[f"d{k}" for k in lags], "d"]
    size = len(columns)
    p, points = "CASE WHEN statistic <= -3.43::DOUBLE THEN 0.01::DOUBLE ", forecast.DF_QUANTILES
    for (a, pa), (b, pb) in zip(points, points[1:]):
        p += f"WHEN statistic <= ({b})::DOUBLE THEN {pa}::DOUBLE + (statistic - ({a})) * ({pb - pa!r}::DOUBLE / {b - a!r}::DOUBLE) "
    p += "WHEN statistic IS NOT NULL THEN 0.99::DOUBLE END"
    last, params = f"m[{size * size}]", "(k - 2 + 2)"
    return _recursive(
        sql(
            """SELECT series, n, CAST(lags AS INTEGER) AS lags, round(aic, 4) AS aic, round(statistic, 4) AS statistic,
                      round(p, 4) AS p_value, p < 0.05::DOUBLE AS is_stationary FROM tested""",
            panel,
            a0=f"""SELECT series, ts, lag(y) OVER w AS x, y - lag(y) OVER w AS d FROM {panel}
                   WINDOW w AS (PARTITION BY series ORDER BY ts)""",
            a1="SELECT *, "
            + ", ".join(f"lag(d, {k}) OVER w AS d{k}" for k in lags)
            + " FROM a0 WINDOW w AS (PARTITION BY series ORDER BY ts)",
            am=_moments_sql("a1", columns),
            asw=_swept_sql("asw", "am", size),
            models=f"""
                SELECT series, n, k - 2 AS lags, CASE WHEN {last} > 0 AND n > k THEN
                           n * (ln(2 * pi() * {last} / n) + 1) + 2 * {params} END AS aic,
                       CASE WHEN n > k AND {last} > 0 AND m[{size + 2}] > 0
                            THEN m[{2 * size}] / sqrt({last} / (n - {params}) * m[{size + 2}]) END AS statistic
                FROM asw WHERE k >= 2""",
            best="""SELECT * FROM models WHERE aic IS NOT NULL
                    QUALIFY row_number() OVER (PARTITION BY series ORDER BY aic, lags) = 1""",
            judged=f"""SELECT s.series, coalesce(n, 0) AS n, lags, aic, statistic
                       FROM (SELECT DISTINCT series FROM {panel}) s LEFT JOIN best USING (series)""",
            tested=f"SELECT *, {p} AS p FROM judged",
        )
    )


def _adf(panel: DataFrame) -> DataFrame:
    out = forecast.adf_stationarity(panel)
    return out.select("series", "n", "lags", r("aic"), r("statistic"), r("p_value"), "is_stationary")


@query("adf_stationarity", _adf_sql("hourly"))
def adf_stationarity(spark: SparkSession, folder: str) -> DataFrame:
    return _adf(views.hourly(spark, folder))


@query("adf_stationarity_entities", _adf_sql("hourlye"))
def adf_stationarity_entities(spark: SparkSession, folder: str) -> DataFrame:
    """One test for every entity."""
    return _adf(views.hourly_entities(spark, folder))


def _sarma_views(panel: str) -> dict[str, str]:
    """The fit in SQL: the long regression by sweeps, the three coefficients by Cramer's rule, the errors row by row."""
    lags = forecast.LONG_LAGS
    columns = [f"l{k}" for k in lags] + ["z"]
    size = len(columns)
    long_fit = " + ".join(f"m[{i * size + size}] * l{k}" for i, k in enumerate(lags))
    pairs = {"a11": "z1 * z1", "a22": "zs * zs", "a33": "e1 * e1", "a12": "z1 * zs", "a13": "z1 * e1", "a23": "zs * e1",
             "b1": "z * z1", "b2": "z * zs", "b3": "z * e1", "szz": "z * z"}
    det = "(a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13) + a13 * (a12 * a23 - a22 * a13))"
    phi = "(b1 * (a22 * a33 - a23 * a23) - a12 * (b2 * a33 - a23 * b3) + a13 * (b2 * a23 - a22 * b3))"
    phs = "(a11 * (b2 * a33 - a23 * b3) - b1 * (a12 * a33 - a23 * a13) + a13 * (a12 * b3 - b2 * a13))"
    theta = "(a11 * (a22 * b3 - b2 * a23) - a12 * (a12 * b3 - b2 * a13) + b1 * (a12 * a23 - a22 * a13))"
    return {
        "g0": VIEWS["sf0"].replace("FROM hourly", f"FROM {panel}"),
        "g1": "SELECT *, lag(z, 1) OVER w AS z1, lag(z, 24) OVER w AS zs, "
        + ", ".join(f"lag(z, {k}) OVER w AS l{k}" for k in lags)
        + " FROM g0 WINDOW w AS (PARTITION BY series ORDER BY ts)",
        "lm": _moments_sql("g1", columns, "train"),
        "lsw": _swept_sql("lsw", "lm", size),
        "g2": f"""SELECT g1.*, z - ({long_fit}) AS e FROM g1 LEFT JOIN (SELECT * FROM lsw WHERE k = {size - 1}) l
                  ON l.series = g1.series""",
        "g3": """SELECT *, coalesce(lag(e) OVER (PARTITION BY series ORDER BY ts), 0) AS e1 FROM g2""",
        "sm": "SELECT series, count(*) AS n, "
        + ", ".join(f"sum({v}) AS {k}" for k, v in pairs.items())
        + " FROM g3 WHERE train AND z1 IS NOT NULL AND zs IS NOT NULL GROUP BY series",
        "s0": f"SELECT *, {phi} / {det} AS phi, {phs} / {det} AS phi_season, {theta} / {det} AS theta0 FROM sm",
        "s1": """SELECT *, (szz - phi * b1 - phi_season * b2 - theta0 * b3) / n AS sigma2,
                        CASE WHEN abs(theta0) > 1 THEN 1 / theta0 ELSE theta0 END AS theta FROM s0""",
        "sarma": "SELECT *, -n / 2 * (ln(2 * pi() * sigma2) + 1) AS llf FROM s1",
        "u": """SELECT series, ts, pos, train, y, y_season + phi * z1 + phi_season * zs AS base, theta,
                       row_number() OVER (PARTITION BY series ORDER BY ts) AS i
                FROM g3 JOIN sarma USING (series) WHERE z1 IS NOT NULL AND zs IS NOT NULL""",
        "er": """SELECT series, i, y - base AS e FROM u WHERE i = 1
                 UNION ALL SELECT u.series, u.i, u.y - u.base - u.theta * er.e FROM er JOIN u ON u.series = er.series AND u.i = er.i + 1""",
        "sfc": """SELECT u.series, ts, pos, train, y AS actual, base + theta * coalesce(er.e, 0) AS forecast
                  FROM u LEFT JOIN er ON er.series = u.series AND er.i = u.i - 1""",
    }


def _sarma_sql(body: str, panel: str = "hourly", **extra: str) -> str:
    return _recursive(sql(body, panel, **_sarma_views(panel), **extra))


_SARMA = """SELECT series, n, round(phi, 6) AS phi, round(phi_season, 6) AS phi_season, round(theta, 6) AS theta,
                   round(sigma2, 4) AS sigma2, round(llf, 4) AS llf, round(8 - 2 * llf, 4) AS aic,
                   round(4 * ln(n) - 2 * llf, 4) AS bic FROM sarma"""


def _sarma_fit(frame: DataFrame) -> DataFrame:
    fit = forecast.panel_sarma_fit(frame).where("reason IS NULL")
    return fit.select(
        "series", "n", *[r(c, 6) for c in ("phi", "phi_season", "theta")], *[r(c) for c in ("sigma2", "llf", "aic", "bic")]
    )


@query("panel_sarma_fit", _sarma_sql(_SARMA))
def panel_sarma_fit(spark: SparkSession, folder: str) -> DataFrame:
    return _sarma_fit(_frame(spark, folder))


@query("panel_sarma_fit_entities", _sarma_sql(_SARMA, "hourlye"))
def panel_sarma_fit_entities(spark: SparkSession, folder: str) -> DataFrame:
    """One model for every entity."""
    return _sarma_fit(forecast.seasonal_frame(views.hourly_entities(spark, folder)))


def _sarma_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    frame = _frame(spark, folder)
    return forecast.panel_sarma_forecast(frame, forecast.panel_sarma_fit(frame))


@query(
    "panel_sarma_forecast",
    _sarma_sql("SELECT series, ts, train, round(actual, 4) AS actual, round(forecast, 4) AS forecast FROM sfc"),
)
def panel_sarma_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return _sarma_forecasts(spark, folder).select("series", "ts", "train", r("actual"), r("forecast"))


@query(
    "sarma_forecast_error",
    _sarma_sql(
        f"""SELECT series, {_ERRORS} FROM (SELECT series, actual AS a, forecast AS f FROM sfc WHERE NOT train)
            GROUP BY series"""
    ),
)
def sarma_forecast_error(spark: SparkSession, folder: str) -> DataFrame:
    out = error_metrics(_sarma_forecasts(spark, folder).where("not train"), keys=["series"])
    return out.select("series", "n", r("mae"), r("rmse"), r("mape"))


@query(
    "panel_sarma_horizon",
    _sarma_sql(
        """SELECT series, CAST(step AS INTEGER) AS step, origin + step * INTERVAL 1 HOUR AS ts,
                  round(ys[48], 4) AS forecast FROM st WHERE step > 0""",
        last_e="SELECT series, arg_max(actual - forecast, pos) AS e FROM sfc WHERE train GROUP BY series",
        st="""
            SELECT series, 0 AS step, list(y ORDER BY ts) AS ys, any_value(phi) AS a, any_value(phi_season) AS b,
                   any_value(theta * e) AS g, max(ts) AS origin
            FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts DESC) AS k FROM g0 WHERE train)
                 JOIN sarma USING (series) JOIN last_e USING (series) WHERE k <= 48 GROUP BY series HAVING count(*) = 48
            UNION ALL
            SELECT series, step + 1, list_append(ys[2:48], ys[25] + a * (ys[48] - ys[24]) + b * (ys[25] - ys[1]) + g),
                   a, b, 0, origin
            FROM st WHERE step < 72""",
    ),
)
def panel_sarma_horizon(spark: SparkSession, folder: str) -> DataFrame:
    frame = _frame(spark, folder)
    out = forecast.panel_sarma_horizon(frame, forecast.panel_sarma_fit(frame), 72)
    return out.select("series", "step", "ts", r("forecast"))
