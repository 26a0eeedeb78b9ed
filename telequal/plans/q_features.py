"""Queries: rolling windows, baselines, breaches, calendar parts and series tails."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telequal.functions import rules
from telequal.functions.calendar import calendar_features as calendar_columns
from telequal.operators import features, incremental, requests
from telequal.operators.panel import measure
from telequal.plans import views
from telequal.plans.registry import query, r, sql
from telequal.session import scratch_path
from telequal.sources.sinks import write_by_date

ORDER = ("ts", "seq")
_W = "(PARTITION BY entity ORDER BY ts, seq ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"
W4, W168 = _W.format(n=3), _W.format(n=167)


def panel(df: DataFrame):
    return measure(df, "entity", ORDER)


@query(
    "rolling_std",
    sql(f"SELECT seq, round(coalesce(stddev_samp(signal) OVER {W4}, 0), 4) AS std4 FROM tele", "tele"),
)
def rolling_std(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder)
    return features.rolling_std(t, panel(t), "signal", "std4").select("seq", r("std4"))


@query(
    "rolling_std_strict",
    sql(
        f"""SELECT seq, round(CASE WHEN count(signal) OVER {W4} = 4 THEN stddev_samp(signal) OVER {W4} ELSE 0 END, 4)
                   AS std4,
                   round(CASE WHEN count(d) OVER {W4} = 4 THEN avg(d) OVER {W4} ELSE 0 END, 5) AS rate4
            FROM (SELECT *, signal - lag(signal) OVER (PARTITION BY entity ORDER BY ts, seq) AS d FROM tele)""",
        "tele",
    ),
)
def rolling_std_strict(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder)
    layout = panel(t)
    out = features.rolling_std(t, layout, "signal", "std4", strict=True)
    out = features.rolling_rate(out, layout, "signal", "rate4", strict=True)
    return out.select("seq", r("std4"), r("rate4", 5))


@query(
    "rolling_rate",
    sql(
        f"""SELECT seq, round(coalesce(avg(d) OVER {W4}, 0), 5) AS rate4
            FROM (SELECT *, signal - lag(signal) OVER (PARTITION BY entity ORDER BY ts, seq) AS d FROM tele)""",
        "tele",
    ),
)
def rolling_rate(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder)
    return features.rolling_rate(t, panel(t), "signal", "rate4").select("seq", r("rate4", 5))


_BASE = f"""SELECT *, CASE WHEN count(signal) OVER {W168} >= 24 THEN avg(signal) OVER {W168} END AS wm,
                   CASE WHEN count(signal) OVER {W168} >= 24 THEN stddev_samp(signal) OVER {W168} END AS ws FROM tele"""


@query(
    "rolling_baseline",
    sql(
        """SELECT seq, round(coalesce(wm, signal), 4) AS base_mean, round(coalesce(ws, 1), 4) AS base_std FROM b""",
        "tele",
        b=_BASE,
    ),
)
def rolling_baseline(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder)
    return features.rolling_baseline(t, panel(t), "signal").select("seq", r("base_mean"), r("base_std"))


@query(
    "rolling_baseline_seriesfill",
    sql(
        """SELECT seq, round(coalesce(wm, am), 4) AS base_mean, round(coalesce(ws, sd), 4) AS base_std
           FROM b JOIN (SELECT entity, avg(signal) AS am, stddev_samp(signal) AS sd FROM tele GROUP BY entity)
           USING (entity)""",
        "tele",
        b=_BASE,
    ),
)
def rolling_baseline_seriesfill(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder)
    out = features.rolling_baseline_seriesfill(t, panel(t), "signal")
    return out.select("seq", r("base_mean"), r("base_std"))


@query(
    "sigma_breach",
    sql(
        """SELECT seq, round(m - 2 * s, 4) AS lower_bound, round((m - signal) / (s + 1e-6), 4) AS deviation_sigmas,
                  CASE WHEN signal < m - 2 * s THEN 1 ELSE 0 END AS breach
           FROM (SELECT seq, signal, coalesce(wm, signal) AS m, coalesce(ws, 1) AS s FROM b)""",
        "tele",
        b=_BASE,
    ),
)
def sigma_breach(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder)
    judged = features.sigma_breach(features.rolling_baseline(t, panel(t), "signal"), "signal", sigmas=2.0)
    return judged.select("seq", r("lower_bound"), r("deviation_sigmas"), "breach")


_ASKED = """SELECT seq, CASE WHEN seq % 97 = 0 THEN NULL ELSE signal END AS x, seq % 97 = 0 AS bad,
                    coalesce(wm, 75) AS m, coalesce(ws, 5) AS s,
                    CASE kind WHEN 'error' THEN 2.0::DOUBLE WHEN 'purchase' THEN 3.0::DOUBLE ELSE 1.5::DOUBLE END AS k FROM b"""


@query(
    "sigma_breach_by_request",
    sql(
        """SELECT seq, CASE WHEN NOT bad THEN x < m - k * s END AS is_breach, CASE WHEN NOT bad THEN x END AS current_score,
                  CASE WHEN NOT bad THEN round(m - k * s, 2) END AS lower_bound,
                  CASE WHEN NOT bad THEN round((m - x) / (s + 1e-6), 2) END AS deviation_sigmas,
                  CASE WHEN NOT bad THEN k END AS sigma_threshold,
                  CASE WHEN bad THEN 'wifi_experience_score is not a valid number' END AS error
           FROM q""",
        "tele",
        b=_BASE,
        q=_ASKED,
    ),
)
def sigma_breach_by_request(spark: SparkSession, folder: str) -> DataFrame:
    """Each reading as a request with its own limit; what it leaves out takes the default."""
    t = views.tele(spark, folder)
    based = features.rolling_baseline(t, panel(t), "signal")
    known = F.count("signal").over(Window.partitionBy("entity").orderBy(*ORDER).rowsBetween(-167, 0)) >= 24
    asked = based.select(
        "seq",
        F.when(F.col("seq") % 97 == 0, "n/a").otherwise(F.col("signal").cast("string")).alias("wifi_experience_score"),
        F.when(known, F.col("base_mean")).alias("rolling_mean_7d"),
        F.when(known, F.col("base_std")).alias("rolling_std_7d"),
        F.when(F.col("kind") == "error", 2.0).when(F.col("kind") != "purchase", 1.5).alias("sigma_threshold"),
    )
    return requests.score_wifi_requests(asked)


@query(
    "sigma_state",
    sql(
        """SELECT seq, CASE WHEN signal < m - 1.5 * s THEN 'breach'
                            WHEN signal > m + 1.5 * s AND signal - m > 15 THEN 'suspicious' ELSE 'normal' END AS state
           FROM (SELECT seq, signal, coalesce(wm, signal) AS m, coalesce(ws, 1) AS s FROM b)""",
        "tele",
        b=f"""SELECT *, CASE WHEN count(signal) OVER {_W.format(n=19)} >= 5 THEN avg(signal) OVER {_W.format(n=19)} END AS wm,
                CASE WHEN count(signal) OVER {_W.format(n=19)} >= 5 THEN stddev_samp(signal) OVER {_W.format(n=19)} END AS ws
              FROM tele""",
    ),
)
def sigma_state(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder)
    based = features.rolling_baseline(t, panel(t), "signal", rows=20, least=5)
    return based.select("seq", features.sigma_state("signal", sigmas=1.5).alias("state"))


_RUN = "(PARTITION BY entity ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)"


@query(
    "running_risk",
    sql(
        f"""SELECT seq, CAST(sum(CASE WHEN signal < 0 THEN 1 ELSE 0 END) OVER {_RUN} AS BIGINT) AS breach_count,
                   CAST(least(99, 12 + sum(CASE WHEN signal < 0 AND kind = 'error' THEN 18 WHEN signal < 0 THEN 9
                                                ELSE 0 END) OVER {_RUN}) AS BIGINT) AS risk FROM tele""",
        "tele",
    ),
)
def running_risk(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder)
    out = features.running_risk(t, panel(t), F.col("signal") < 0, F.col("kind") == "error")
    return out.select("seq", "breach_count", "risk")


@query(
    "calendar_features",
    """SELECT event_id, CAST(h AS INTEGER) AS hour_of_day, CAST(d AS INTEGER) AS day_of_week,
              CASE WHEN h BETWEEN 19 AND 22 THEN 1 ELSE 0 END AS is_peak_hour,
              CASE WHEN d >= 5 THEN 1 ELSE 0 END AS is_weekend,
              round(sin(2 * pi() * h / 24), 4) AS hour_sin, round(cos(2 * pi() * h / 24), 4) AS hour_cos,
              round(sin(2 * pi() * d / 7), 4) AS dow_sin, round(cos(2 * pi() * d / 7), 4) AS dow_cos
       FROM (SELECT event_id, hour(ts) AS h, isodow(ts) - 1 AS d FROM events)""",
)
def calendar_features(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder)
    return t.select(F.col("seq").alias("event_id"), *[c.alias(n) for n, c in calendar_columns("ts").items()])


@query(
    "tail_hours",
    sql(
        """SELECT series, ts, round(y, 4) AS y FROM (
             SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts DESC) AS k FROM hourly) WHERE k <= 48""",
        "hourly",
    ),
)
def tail_hours(spark: SparkSession, folder: str) -> DataFrame:
    back = F.row_number().over(Window.partitionBy("series").orderBy(F.col("ts").desc()))
    last = views.hourly(spark, folder).withColumn("k", back).where("k <= 48")
    return last.select("series", "ts", r("y"))


@query(
    "device_status",
    sql(
        """SELECT series, ts, CASE WHEN y >= 75 THEN 'good' WHEN y >= 55 THEN 'fair' ELSE 'poor' END AS status
           FROM hourly""",
        "hourly",
    ),
)
def device_status(spark: SparkSession, folder: str) -> DataFrame:
    return views.hourly(spark, folder).select("series", "ts", rules.device_status(F.col("y")).alias("status"))


@query(
    "derived_ratio",
    """SELECT o_orderkey, o_custkey, round(o_totalprice - (o_custkey + 38.0::DOUBLE), 3) AS power_delta,
              round(o_totalprice / greatest(o_custkey, 1), 4) AS charge_per_tenure,
              round(least(o_custkey, 600) / 600, 4) AS severity FROM orders""",
)
def derived_ratio(spark: SparkSession, folder: str) -> DataFrame:
    from telequal.sources.tables import table

    o = table(spark, folder, "orders")
    price, key = F.col("o_totalprice"), F.col("o_custkey")
    return o.select(
        "o_orderkey",
        "o_custkey",
        rules.power_delta(price, key).alias("power_delta"),
        rules.charge_per_tenure(price, key).alias("charge_per_tenure"),
        rules.severity_score(key).alias("severity"),
    )


@query(
    "signal_score_rules",
    sql(
        """SELECT seq, round(s, 4) AS score,
                  CASE WHEN s > 0.37::DOUBLE + 0.15::DOUBLE THEN 'High' WHEN s > 0.37::DOUBLE THEN 'Medium'
                       ELSE 'Normal' END AS severity
           FROM (SELECT seq, least(0.97::DOUBLE, greatest(0.04::DOUBLE,
                   greatest(0, (signal - 38) * -1 * 0.028::DOUBLE) + greatest(0, (38 - 50) * 0.014::DOUBLE)
                   + greatest(0, (aux - 80) * 0.009::DOUBLE) + 0.11::DOUBLE)) AS s FROM tele)""",
        "tele",
    ),
)
def signal_score_rules(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder).withColumn("us_power_level_dbmv", F.lit(None).cast("double"))
    score = rules.signal_risk_score({"ds_snr_db": "signal", "ds_channel_utilization_pct": "aux"})
    return t.withColumn("s", score).select(
        "seq", r("s", 4, "score"), rules.severity_band(F.col("s"), rules.SIGNAL_THRESHOLD).alias("severity")
    )


_FILLED = "last_value({c} IGNORE NULLS) OVER (PARTITION BY entity ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS {c}"


@query(
    "incremental_baseline",
    sql(
        """SELECT seq, round(signal, 4) AS signal, round(aux, 4) AS aux, round(coalesce(wm, signal), 4) AS base_mean,
                  round(coalesce(ws, 1), 4) AS base_std FROM b""",
        "telen",
        f=f"SELECT entity, ts, seq, {_FILLED.format(c='signal')}, {_FILLED.format(c='aux')} FROM telen",
        b=_BASE.replace("FROM tele", "FROM f"),
    ),
)
def incremental_baseline(spark: SparkSession, folder: str) -> DataFrame:
    """All readings in three runs by date, each from the tail of the one before, appended by date; equals one batch."""
    t = views.tele_nulled(spark, folder).select("entity", "ts", "seq", "signal", "aux")
    ends = t.agg(F.unix_date(F.to_date(F.min("ts"))).alias("a"), F.unix_date(F.to_date(F.max("ts"))).alias("b")).first()
    day, step = F.unix_date(F.to_date("ts")), (ends["b"] - ends["a"]) // 3 + 1
    path, carried = scratch_path(spark, "prepared"), None
    for k in range(3):
        first = ends["a"] + k * step
        part = t.where((day >= first) & (day < first + step))
        prepared, carried = incremental.advance(part, carried, "entity", ORDER, ["signal", "aux"], "signal")
        write_by_date(prepared, path, "ts")
    return spark.read.parquet(path).select("seq", r("signal"), r("aux"), r("base_mean"), r("base_std"))
