"""Forecasting every series of a panel with grouped moments.

All series have one row per hour, so a series is bounded by the calendar.  The model is a
seasonal autoregression: z(t) = y(t) - y(t-24) on z(t-1) and z(t-24), least squares in closed form.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telequal.operators import leastsq
from telequal.operators.evaluate import confusion_metrics, forecast_error
from telequal.schemas import SEASON, SIGMAS, TRAIN_SHARE

# Fixed value: 5 percent critical value of the Dickey-Fuller test with constant.
DF_CRITICAL_5PCT = -2.86
# Quantiles of the Dickey-Fuller statistic with constant, for long series (Fuller 1976, table 8.5.2; the
# three middle ones from the response surface of MacKinnon 1994).
DF_QUANTILES = [
    (-3.43, 0.01), (-3.12, 0.025), (-2.86, 0.05), (-2.57, 0.10), (-2.085, 0.25), (-1.566, 0.50), (-1.009, 0.75),
    (-0.44, 0.90), (-0.07, 0.95), (0.23, 0.975), (0.60, 0.99),
]
MOST_ADF_LAGS = 12
# Lags of the long autoregression whose residuals stand for the errors of the moving average.
LONG_LAGS = (1, 2, 3, 4, 5, 6, SEASON, SEASON + 1, SEASON + 2)
# Values that a running array keeps apart, so that appending to it stays cheap.
SCAN_CHUNK = 256


def hour_grid(df: DataFrame, series: str, ts: str, value: str) -> DataFrame:
    """Mean per series and hour, every hour from the first to the last present, gaps carried forward."""
    means = df.groupBy(F.col(series).alias("series"), F.date_trunc("hour", F.col(ts)).alias("ts")).agg(
        F.avg(value).alias("_mean")
    )
    hours = means.groupBy("series").agg(
        F.sequence(F.min("ts"), F.max("ts"), F.expr("interval 1 hour")).alias("_hours")
    )
    grid = hours.select("series", F.explode("_hours").alias("ts"))
    w = Window.partitionBy("series").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return grid.join(means, ["series", "ts"], "left").select(
        "series", "ts", F.last("_mean", ignorenulls=True).over(w).alias("y")
    )


def seasonal_frame(panel: DataFrame, season: int = SEASON, share: float = TRAIN_SHARE) -> DataFrame:
    """Add position, train flag, y(t-season), z(t), z(t-1) and z(t-season)."""
    w = Window.partitionBy("series").orderBy("ts")
    n = F.count(F.lit(1)).over(Window.partitionBy("series"))
    return (
        panel.withColumns(
            {
                "pos": F.row_number().over(w) - 1,
                "train": (F.row_number().over(w) - 1) < F.floor(n * F.lit(share)),
                "y_season": F.lag("y", season).over(w),
            }
        )
        .withColumn("z", F.col("y") - F.col("y_season"))
        .withColumns({"z1": F.lag("z", 1).over(w), "zs": F.lag("z", season).over(w)})
    )


def panel_sar_fit(frame: DataFrame) -> DataFrame:
    """One row per series: phi (lag 1), seasonal phi, n, residual variance, llf, aic and bic.

    A series whose training part is too short for any pair of lags has null parameters and the ``reason``
    'too little history'; all others have a null reason.
    """

    def s(a: str, b: str) -> Column:
        return F.sum(F.col(a) * F.col(b))

    m = (
        frame.where(F.col("train") & F.col("z1").isNotNull() & F.col("zs").isNotNull())
        .groupBy("series")
        .agg(
            F.count(F.lit(1)).alias("n"),
            s("z1", "z1").alias("s11"),
            s("zs", "zs").alias("s22"),
            s("z1", "zs").alias("s12"),
            s("z", "z1").alias("b1"),
            s("z", "zs").alias("b2"),
            s("z", "z").alias("szz"),
        )
    )
    c = F.col
    det = c("s11") * c("s22") - c("s12") * c("s12")
    phi = F.when(det != 0, (c("b1") * c("s22") - c("b2") * c("s12")) / det).otherwise(F.lit(0.0))
    phs = F.when(det != 0, (c("b2") * c("s11") - c("b1") * c("s12")) / det).otherwise(F.lit(0.0))
    sse = c("szz") - c("phi") * c("b1") - c("phi_season") * c("b2")
    llf = -c("n") / 2.0 * (F.log(F.lit(2 * math.pi) * c("sigma2")) + F.lit(1.0))
    every = frame.groupBy("series").agg(F.count_if("train").alias("n_train"))
    return (
        every.join(m.withColumns({"phi": phi, "phi_season": phs}), "series", "left")
        .withColumn("sigma2", sse / c("n"))
        .withColumn("llf", llf)
        .select(
            "series",
            F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
            "phi",
            "phi_season",
            "sigma2",
            "llf",
            (F.lit(6.0) - c("llf") * 2).alias("aic"),
            (F.log(c("n")) * 3 - c("llf") * 2).alias("bic"),
            F.when(c("n").isNull(), "too little history").alias("reason"),
        )
    )


def panel_sar_forecast(frame: DataFrame, fit: DataFrame) -> DataFrame:
    """One-step-ahead forecast of every row with enough history: (series, ts, train, actual, forecast).

    A series without a fit has the value of one season before, where there is one, else a null forecast.
    """
    fitted = F.col("y_season") + F.col("phi") * F.col("z1") + F.col("phi_season") * F.col("zs")
    value = F.when(F.col("phi").isNull(), F.col("y_season")).otherwise(fitted)
    return (
        frame.join(fit.select("series", "phi", "phi_season"), "series")
        .where(F.col("phi").isNull() | (F.col("z1").isNotNull() & F.col("zs").isNotNull()))
        .select("series", "ts", "pos", "train", F.col("y").alias("actual"), value.alias("forecast"))
    )


def panel_sar_horizon(frame: DataFrame, fit: DataFrame, steps: int, season: int = SEASON) -> DataFrame:
    """Forecast ``steps`` hours past the training part of each series, feeding forecasts back.

    Only the last ``2 * season`` training values of a series are needed, so the state of a series is a
    short array that a fold extends step by step.  A series without a fit or with fewer values repeats its
    last season; one shorter than a season has null forecasts.
    """
    last = frame.where("train").withColumn(
        "_back", F.row_number().over(Window.partitionBy("series").orderBy(F.col("ts").desc()))
    )
    tail = (
        last.where(F.col("_back") <= 2 * season)
        .groupBy("series")
        .agg(
            F.max("ts").alias("origin"),
            F.transform(
                F.sort_array(F.collect_list(F.struct("ts", "y"))), lambda p: p["y"]
            ).alias("_y"),
        )
    )

    def extend(y: Column, _: Column) -> Column:
        def at(k: int) -> Column:
            return F.get(y, F.size(y) - k)

        z1, zs = at(1) - at(season + 1), at(season) - at(2 * season)
        fitted = at(season) + F.col("phi") * z1 + F.col("phi_season") * zs
        return F.concat(y, F.array(F.when(F.size("_y") < 2 * season, at(season)).otherwise(F.coalesce(fitted, at(season)))))

    path = F.slice(
        F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.col("_y"), extend), F.size("_y") + 1, F.lit(steps)
    )
    return (
        tail.join(fit.select("series", "phi", "phi_season"), "series")
        .select("series", "origin", F.posexplode(path).alias("_i", "forecast"))
        .select(
            "series",
            (F.col("_i") + 1).alias("step"),
            (F.col("origin") + F.make_dt_interval(hours=F.col("_i") + 1)).alias("ts"),
            "forecast",
        )
    )


def _running(values: Column, start: Column, step) -> Column:
    """All states of ``state = step(state, value)`` over an array, as an array of doubles.

    States are gathered in chunks that are joined once each, so the work grows with n + n^2 / SCAN_CHUNK copies only.
    """
    none = F.array().cast("array<double>")

    def one(a: Column, v: Column) -> Column:
        now = step(a["last"], v)
        return F.struct(now.alias("last"), F.array_append(a["out"], now).alias("out"))

    def chunk(a: Column, k: Column) -> Column:
        part = F.slice(values, k * SCAN_CHUNK + 1, F.lit(SCAN_CHUNK))
        done = F.aggregate(part, F.struct(a["last"].alias("last"), none.alias("out")), one)
        return F.struct(done["last"].alias("last"), F.concat(a["out"], done["out"]).alias("out"))

    chunks = F.sequence(F.lit(0), F.greatest(F.floor((F.size(values) - 1) / SCAN_CHUNK).cast("int"), F.lit(0)))
    return F.aggregate(chunks, F.struct(start.cast("double").alias("last"), none.alias("out")), chunk)["out"]


def _long_residuals(frame: DataFrame, lags: tuple[int, ...] = LONG_LAGS) -> DataFrame:
    """``frame`` with ``e1``: the previous residual of a long autoregression of z, 0 where there is none yet."""
    w = Window.partitionBy("series").orderBy("ts")
    names = [f"_z{k}" for k in lags]
    lagged = frame.withColumns({c: F.lag("z", k).over(w) for c, k in zip(names, lags)})
    size = len(lags) + 1
    fit = leastsq.solve(leastsq.cross_moments(lagged.where("train"), ["series"], [*names, "z"]), size)
    fit = fit.select("series", *[leastsq.coefficient(F.col("solved"), size, i).alias(f"_a{i}") for i in range(len(lags))])
    explained = sum((F.col(f"_a{i}") * F.col(c) for i, c in enumerate(names)), F.lit(0.0))
    both = lagged.join(fit, "series", "left").withColumn("_e", F.col("z") - explained)
    return both.withColumn("e1", F.coalesce(F.lag("_e").over(w), F.lit(0.0))).select(*frame.columns, "e1")


def panel_sarma_fit(frame: DataFrame, lags: tuple[int, ...] = LONG_LAGS) -> DataFrame:
    """The seasonal autoregression with a moving-average term, z on z1, zs and the previous error, for every series.

    Two passes (Hannan and Rissanen): residuals of a long autoregression stand for the errors, then one regression has
    three coefficients.  A moving average that cannot be inverted (beyond 1) is replaced by the one of the same
    autocorrelation that can.  Rows are those of :func:`panel_sar_fit`, so both AICs compare.  Columns: ``series``, ``n``,
    ``phi``, ``phi_season``, ``theta``, ``sigma2``, ``llf``, ``aic``, ``bic``, ``reason``.
    """
    c, size = F.col, 4
    used = _long_residuals(frame, lags).where("train")
    solved = leastsq.solve(leastsq.cross_moments(used, ["series"], ["z1", "zs", "e1", "z"]), size)
    phi, phs, theta = (leastsq.coefficient(c("solved"), size, k) for k in range(3))
    llf = -c("n") / 2.0 * (F.log(F.lit(2 * math.pi) * c("sigma2")) + F.lit(1.0))
    every = frame.groupBy("series").agg(F.count_if("train").alias("n_train"))
    fit = solved.select("series", "n", phi.alias("phi"), phs.alias("phi_season"), theta.alias("theta"),
                        (leastsq.squared_error(c("solved"), size) / c("n")).alias("sigma2"))
    return (
        every.join(fit, "series", "left")
        .withColumn("theta", F.when(F.abs("theta") > 1, F.lit(1.0) / c("theta")).otherwise(c("theta")))
        .withColumn("llf", F.when(c("sigma2") > 0, llf))
        .select(
            "series",
            F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
            *["phi", "phi_season", "theta", "sigma2", "llf"],
            (F.lit(8.0) - c("llf") * 2).alias("aic"),
            (F.log(c("n")) * 4 - c("llf") * 2).alias("bic"),
            F.when(c("n").isNull(), "too little history").alias("reason"),
        )
    )


def _errors(theta: Column, explained: Column) -> Column:
    """Errors e(t) = u(t) - theta * e(t-1) of an array u, null where u is; a gap starts again from 0."""
    return _running(explained, F.lit(0.0), lambda e, u: F.coalesce(u - theta * e, F.lit(0.0)))


def panel_sarma_forecast(frame: DataFrame, fit: DataFrame) -> DataFrame:
    """One-step-ahead forecasts with the error of the step before, as :func:`panel_sar_forecast` gives them.

    The errors of a series are carried through an array of its rows, which the calendar bounds.  A series without a fit
    has the value of one season before.
    """
    c = F.col
    rows = frame.join(fit.select("series", "phi", "phi_season", "theta"), "series")
    known = c("z1").isNotNull() & c("zs").isNotNull()
    without = c("y_season") + c("phi") * c("z1") + c("phi_season") * c("zs")
    fitted = rows.where(c("phi").isNotNull() & known).select(
        "series", "theta", F.struct("ts", "pos", "train", "y", without.alias("base")).alias("_r")
    )
    series = fitted.groupBy("series").agg(F.max("theta").alias("theta"), F.sort_array(F.collect_list("_r")).alias("_rows"))
    errors = _errors(c("theta"), F.transform("_rows", lambda r: r["y"] - r["base"]))
    after = F.concat(F.array(F.lit(0.0)), F.slice("_e", 1, F.size("_e") - 1))
    carried = (
        series.withColumn("_e", errors)
        .select("series", "theta", F.explode(F.arrays_zip("_rows", after.alias("e1"))).alias("_x"))
        .select(
            "series", "_x._rows.ts", "_x._rows.pos", "_x._rows.train", c("_x._rows.y").alias("actual"),
            (c("_x._rows.base") + c("theta") * c("_x.e1")).alias("forecast"),
        )
    )
    naive = rows.where(c("phi").isNull()).select(
        "series", "ts", "pos", "train", c("y").alias("actual"), c("y_season").alias("forecast")
    )
    return carried.unionByName(naive)


def panel_sarma_horizon(frame: DataFrame, fit: DataFrame, steps: int, season: int = SEASON) -> DataFrame:
    """Forecast ``steps`` hours past the training part, feeding forecasts back; the last error enters the first step.

    Otherwise as :func:`panel_sar_horizon`, whose path it takes: the first error adds ``theta * e`` to step 1, and what
    that moves later steps by follows from the same recursion.
    """
    plain = panel_sar_horizon(frame, fit, steps, season)
    last = panel_sarma_forecast(frame.where("train"), fit).groupBy("series").agg(
        F.max_by(F.col("actual") - F.col("forecast"), "pos").alias("_e")
    )
    moves = fit.join(last, "series", "left").select(
        "series", "phi", "phi_season", F.coalesce(F.col("theta") * F.col("_e"), F.lit(0.0)).alias("_g")
    )

    def extend(d: Column, _: Column) -> Column:
        # Of a path y(t) = y(t-s) + phi * z(t-1) + phi_season * z(t-s) the change alone: history has none.
        def at(k: int) -> Column:
            return F.coalesce(F.get(d, F.size(d) - k), F.lit(0.0))

        z1, zs = at(1) - at(season + 1), at(season) - at(2 * season)
        return F.array_append(d, at(season) + F.col("phi") * z1 + F.col("phi_season") * zs)

    path = F.aggregate(F.sequence(F.lit(2), F.lit(max(2, steps))), F.array("_g"), extend)
    moved = moves.where("phi IS NOT NULL").select("series", F.posexplode(path).alias("_i", "_d"))
    return plain.join(moved.select("series", (F.col("_i") + 1).alias("step"), "_d"), ["series", "step"], "left").select(
        "series", "step", "ts", (F.col("forecast") + F.coalesce("_d", F.lit(0.0))).alias("forecast")
    )


def seasonal_naive_error(frame: DataFrame) -> DataFrame:
    """Error of yesterday's value at the same hour, on the test part."""
    test = frame.where(~F.col("train")).select("series", F.col("y").alias("actual"), F.col("y_season").alias("forecast"))
    return forecast_error(test, keys=["series"])


def df_stationarity(panel: DataFrame, critical: float = DF_CRITICAL_5PCT) -> DataFrame:
    """Dickey-Fuller regression of the change on the previous value, per series.

    The statistic is null for a series of three hours or fewer and for one without error.
    """
    prev = F.lag("y").over(Window.partitionBy("series").orderBy("ts"))
    x, d = F.col("_prev"), F.col("_d")
    m = (
        panel.withColumn("_prev", prev)
        .withColumn("_d", F.col("y") - F.col("_prev"))
        .where("_prev is not null")
        .groupBy("series")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.regr_slope(d, x).alias("slope"),
            F.regr_sxx(d, x).alias("sxx"),
            F.regr_syy(d, x).alias("syy"),
            F.regr_sxy(d, x).alias("sxy"),
        )
    )
    sse = F.col("syy") - F.col("slope") * F.col("sxy")
    error = F.try_divide(F.try_divide(sse, (F.col("n") - 2).cast("double")), F.col("sxx"))
    t = F.try_divide(F.col("slope"), F.sqrt(F.greatest(error, F.lit(0.0))))
    return m.select("series", "n", "slope", t.alias("statistic")).withColumn(
        "is_stationary", F.col("statistic") < F.lit(critical)
    )


def unit_root_p(statistic: Column) -> Column:
    """p value of a Dickey-Fuller statistic with constant, between the quantiles of ``DF_QUANTILES`` on straight lines.

    Values beyond the table have its outer p values, 0.01 and 0.99.
    """
    p = F.when(statistic <= DF_QUANTILES[0][0], F.lit(DF_QUANTILES[0][1]))
    for (a, pa), (b, pb) in zip(DF_QUANTILES, DF_QUANTILES[1:]):
        p = p.when(statistic <= b, F.lit(pa) + (statistic - F.lit(a)) * F.lit((pb - pa) / (b - a)))
    return p.when(statistic.isNotNull(), F.lit(DF_QUANTILES[-1][1]))


def adf_stationarity(panel: DataFrame, max_lag: int = MOST_ADF_LAGS, alpha: float = 0.05) -> DataFrame:
    """Augmented Dickey-Fuller test of every series, the number of lagged changes chosen by AIC.

    The change is regressed on a constant, the previous value and 0 to ``max_lag`` earlier changes.  All models use the rows
    that have ``max_lag`` changes before them and come from one set of moments: each further lag is one more sweep.  The
    smallest AIC counts, ties by fewer lags.  Columns: ``series``, ``n``, ``lags``, ``aic``, ``statistic``, ``p_value``,
    ``is_stationary``.  A series of too few rows, without error or without movement has null results.
    """
    w = Window.partitionBy("series").orderBy("ts")
    names = [f"_d{k}" for k in range(1, max_lag + 1)]
    changes = panel.select("series", "ts", "y", F.lag("y").over(w).alias("_prev")).withColumns(
        {"_d": F.col("y") - F.col("_prev"), "_one": F.lit(1.0)}
    )
    lagged = changes.withColumns({c: F.lag("_d", k).over(w) for k, c in enumerate(names, 1)})
    columns = ["_one", "_prev", *names, "_d"]
    size = len(columns)
    start = F.col("moments")
    kind = "array<struct<lags:int,sse:double,b:double,c:double>>"

    def further(acc: Column, k: Column) -> Column:
        m = leastsq.swept(acc["m"], start, size, k)
        model = F.struct(
            (k - 1).alias("lags"),
            leastsq.squared_error(m, size).alias("sse"),
            leastsq.cell(m, size, 1, size - 1).alias("b"),
            leastsq.cell(m, size, 1, 1).alias("c"),
        )
        return F.struct(m.alias("m"), F.array_append(acc["path"], model).alias("path"))

    first = F.struct(leastsq.swept(start, start, size, 0).alias("m"), F.array().cast(kind).alias("path"))
    path = F.aggregate(F.sequence(F.lit(1), F.lit(size - 2)), first, further)["path"]
    found = leastsq.cross_moments(lagged, ["series"], columns)
    n, sse = F.col("n"), F.col("_m.sse")
    params = F.col("_m.lags") + 2
    error = F.try_divide(sse, F.when(n > params, (n - params).cast("double"))) * F.col("_m.c")
    models = found.select("series", "n", F.explode(path).alias("_m")).select(
        "series",
        "n",
        F.col("_m.lags").alias("lags"),
        F.when((sse > 0) & (n > params), n * (F.log(F.lit(2 * math.pi) * sse / n) + 1) + params * 2).alias("aic"),
        F.try_divide(F.col("_m.b"), F.sqrt(F.when(error > 0, error))).alias("statistic"),
    )
    best = models.where("aic IS NOT NULL").groupBy("series").agg(
        F.min(F.struct("aic", "lags", "statistic", "n")).alias("_best")
    )
    every = panel.select("series").distinct().join(best, "series", "left")
    p = unit_root_p(F.col("_best.statistic"))
    return every.select(
        "series",
        F.coalesce("_best.n", F.lit(0).cast("bigint")).alias("n"),
        *[F.col(f"_best.{c}").alias(c) for c in ("lags", "aic", "statistic")],
        p.alias("p_value"),
        (p < F.lit(alpha)).alias("is_stationary"),
    )


def _chi2_tail(x: str, dof: int) -> str:
    """Upper tail for an even number of degrees of freedom, as SQL."""
    terms = " + ".join(f"power({x} / 2, {i}) / {float(math.factorial(i))}D" for i in range(dof // 2))
    return f"exp(-{x} / 2) * ({terms})"


def ljung_box(residuals: DataFrame, lags: tuple[int, int] = (10, 20), alpha: float = 0.05) -> DataFrame:
    """Per series: residual mean and deviation, Q statistic and p value at both lags, white-noise flag.

    ``residuals`` has (series, ts, e).  A constant series, or one no longer than a lag, has null statistics.
    """
    short, long = lags
    centred = residuals.selectExpr("series", "ts", "e", "e - avg(e) over (partition by series) as c")
    lagged = centred.selectExpr(
        "series", "e", "c", *[f"lag(c, {k}) over (partition by series order by ts) as l{k}" for k in range(1, long + 1)]
    )
    products = ", ".join(f"sum(c * l{k})" for k in range(1, long + 1))
    m = lagged.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("e").alias("residual_mean"),
        F.stddev_samp("e").alias("residual_std"),
        F.expr("sum(c * c)").alias("s0"),
        F.expr(f"array({products})").alias("s"),
    )

    def q(upto: int) -> str:
        terms = " + ".join(f"try_divide(power(try_divide(s[{k - 1}], s0), 2), n - {k})" for k in range(1, upto + 1))
        return f"n * (n + 2) * ({terms}) as q{upto}"

    tests = m.selectExpr("series", "n", "residual_mean", "residual_std", q(short), q(long)).selectExpr(
        "*", f"{_chi2_tail(f'q{short}', short)} as p{short}", f"{_chi2_tail(f'q{long}', long)} as p{long}"
    )
    return tests.withColumn("white_noise", (F.col(f"p{short}") > alpha) & (F.col(f"p{long}") > alpha))


def forecast_breach_eval(forecasts: DataFrame, baseline: DataFrame, sigmas: float = SIGMAS) -> DataFrame:
    """Breaches called by the forecast against breaches of the actual value, aligned on (series, ts).

    ``baseline`` has (series, ts, base_mean, base_std).
    """
    bound = F.col("base_mean") - F.lit(float(sigmas)) * F.col("base_std")
    joined = forecasts.where(~F.col("train")).join(baseline, ["series", "ts"])
    judged = joined.select(
        "series",
        F.when(F.col("actual") < bound, 1).otherwise(0).alias("breach"),
        (F.col("forecast") < bound).alias("called"),
    )
    return confusion_metrics(judged, "breach", F.col("called"), ["series"])
