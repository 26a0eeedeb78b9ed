"""Queries: cross-entity signals, recency, risk scores, bands, reasons and dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telequal.functions import rules
from telequal.functions.numbers import steady_round
from telequal.operators import signals, stats
from telequal.operators.ordered import instant
from telequal.plans import views
from telequal.plans.registry import query, r, sql
from telequal.sources.tables import table


@query(
    "dim_lookup",
    """SELECT s_suppkey, s_name, n_name, r_name FROM supplier
       LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def dim_lookup(spark: SparkSession, folder: str) -> DataFrame:
    s, n, g = (table(spark, folder, t) for t in ("supplier", "nation", "region"))
    out = signals.dim_lookup(s.withColumnRenamed("s_nationkey", "n_nationkey"), n, "n_nationkey")
    out = signals.dim_lookup(out.withColumnRenamed("n_regionkey", "r_regionkey"), g, "r_regionkey")
    return out.select("s_suppkey", "s_name", "n_name", "r_name")


_CROSS = """SELECT t.*, CASE WHEN e.entity IS NULL THEN 0 ELSE 1 END AS near_error FROM tele t LEFT JOIN (
              SELECT DISTINCT entity, date_trunc('hour', ts) AS h FROM tele WHERE kind = 'error') e
            ON e.entity = t.entity AND e.h = date_trunc('hour', t.ts) WHERE t.kind <> 'error'"""


def _crossed(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder)
    errors, rest = t.where("kind = 'error'"), t.where("kind <> 'error'")
    return signals.cross_signal_flag(rest, errors, "entity", "ts", "near_error")


@query("cross_signal_flag", sql(f"SELECT seq, near_error FROM ({_CROSS})", "tele"))
def cross_signal_flag(spark: SparkSession, folder: str) -> DataFrame:
    return _crossed(spark, folder).select("seq", "near_error")


@query(
    "cooccurrence_rate",
    sql(
        f"""SELECT count(*) FILTER (WHERE signal < 0) AS n_breach,
                   count(*) FILTER (WHERE signal < 0 AND near_error = 1) AS n_both,
                   round(count(*) FILTER (WHERE signal < 0 AND near_error = 1) / count(*) FILTER (WHERE signal < 0), 6)
                       AS rate FROM ({_CROSS})""",
        "tele",
    ),
)
def cooccurrence_rate(spark: SparkSession, folder: str) -> DataFrame:
    x = _crossed(spark, folder).withColumn("breach", F.when(F.col("signal") < 0, 1).otherwise(0))
    return signals.cooccurrence_rate(x, "breach", "near_error").withColumn("rate", r("rate", 6))


@query(
    "trailing_event_count",
    sql(
        """SELECT entity, CAST(sum(flag) AS BIGINT) AS anomaly_count FROM tele
           WHERE ts >= (SELECT max(ts) - INTERVAL 10 DAY FROM tele) GROUP BY entity""",
        "tele",
    ),
)
def trailing_event_count(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder)
    cutoff = instant(t.agg(F.unix_micros(F.max("ts") - F.expr("interval 10 day"))).first()[0])
    return signals.trailing_event_count(t, "entity", "ts", "flag", cutoff, "anomaly_count")


@query(
    "enrich_left_default",
    """SELECT c_custkey, coalesce(n, 0) AS n_large, coalesce(s, 0) AS large_total FROM customer LEFT JOIN (
         SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS s FROM orders
         WHERE o_totalprice > 450000 GROUP BY o_custkey) ON o_custkey = c_custkey""",
)
def enrich_left_default(spark: SparkSession, folder: str) -> DataFrame:
    facts = (
        table(spark, folder, "orders")
        .where("o_totalprice > 450000")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n_large"), r(F.sum("o_totalprice"), 2, "large_total"))
    )
    c = table(spark, folder, "customer").select("c_custkey")
    return signals.enrich_left_default(c, facts, "c_custkey", {"n_large": 0, "large_total": 0.0})


@query(
    "recency_days",
    sql(
        """SELECT c_custkey, coalesce(CAST(floor((epoch_us((SELECT u FROM b)) - epoch_us(greatest(a, e))) / 86400000000)
                  AS BIGINT), 90) AS days_since_last
           FROM customer LEFT JOIN (SELECT entity, max(ts) AS a FROM tele WHERE flag = 1 AND aux > 60 GROUP BY entity) x
                ON x.entity = c_custkey
           LEFT JOIN (SELECT entity, max(ts) AS e FROM tele WHERE aux > 97 GROUP BY entity) y ON y.entity = c_custkey""",
        "tele",
        b="SELECT date_trunc('day', max(ts)) + INTERVAL 1 DAY AS u FROM tele",
    ),
)
def recency_days(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder).withColumnRenamed("entity", "c_custkey")
    marked = t.withColumns(
        {
            "bad": F.when((F.col("flag") == 1) & (F.col("aux") > 60), 1).otherwise(0),
            "breach": F.when(F.col("aux") > 97, 1).otherwise(0),
        }
    )
    last_day = F.date_trunc("day", F.max("ts"))
    until = instant(t.agg(F.unix_micros(last_day + F.expr("interval 1 day"))).first()[0])
    return signals.recency_days(
        table(spark, folder, "customer").select("c_custkey"),
        "c_custkey",
        [
            signals.last_event(marked, "c_custkey", "ts", "bad", "a"),
            signals.last_event(marked, "c_custkey", "ts", "breach", "e"),
        ],
        until,
    )


CRM_COLUMNS = [
    "customer_id",
    "contract_type",
    "payment_method",
    "internet_service_type",
    "tenure_months",
    "monthly_charges",
    "charge_per_tenure_ratio",
    "tech_support_flag",
    "paperless_billing_flag",
    "service_call_frequency_30d",
    "anomaly_count_30d",
    "anomaly_severity_score",
    "wifi_breach_count_30d",
    "days_since_last_anomaly",
]


@query("customer_snapshot", sql(f"SELECT {', '.join(CRM_COLUMNS)} FROM customers", "customers"))
def customer_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return views.customers(spark, folder).select(*CRM_COLUMNS)


@query("percentile_label", sql("SELECT customer_id, risk_score, churn FROM crm", "crm"))
def percentile_label(spark: SparkSession, folder: str) -> DataFrame:
    return views.crm(spark, folder).select("customer_id", "risk_score", "churn")


_FALLBACK = """least(0.97::DOUBLE, greatest(0.03::DOUBLE, 0.04::DOUBLE
    + CASE contract_type WHEN 'Month-to-month' THEN 0.28::DOUBLE WHEN 'One year' THEN 0.09::DOUBLE ELSE 0 END
    + CASE WHEN tenure_months < 6 THEN 0.18::DOUBLE WHEN tenure_months < 18 THEN 0.09::DOUBLE ELSE 0 END
    + CASE WHEN monthly_charges > 85 THEN 0.10::DOUBLE WHEN monthly_charges > 70 THEN 0.05::DOUBLE ELSE 0 END
    + CASE WHEN payment_method = 'Electronic check' THEN 0.07::DOUBLE ELSE 0 END
    + CASE WHEN tech_support_flag = 0 THEN 0.06::DOUBLE ELSE 0 END
    + CASE WHEN internet_service_type = 'Fiber optic' THEN 0.04::DOUBLE ELSE 0 END
    + CASE WHEN days_since_last_anomaly < 7 THEN 0.06::DOUBLE ELSE 0 END
    + least(anomaly_count_30d / 300, 0.14::DOUBLE) + least(wifi_breach_count_30d / 80, 0.10::DOUBLE)))"""
_PROB = {"p": f"SELECT *, round({_FALLBACK}, 4) AS prob FROM customers"}
_BAND = "CASE WHEN prob >= 0.3::DOUBLE + 0.2::DOUBLE THEN 'High' WHEN prob >= 0.3::DOUBLE THEN 'Medium' ELSE 'Low' END"


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    c = views.customers(spark, folder).withColumn("prob", steady_round(rules.fallback_risk_score(), 4))
    return c.withColumn("risk", rules.risk_band(F.col("prob"), 0.3))


@query("risk_score_rules", sql("SELECT customer_id, prob FROM p", "customers", **_PROB))
def risk_score_rules(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select("customer_id", "prob")


@query(
    "risk_band",
    sql(
        f"""SELECT customer_id, {_BAND} AS risk,
                   CASE WHEN prob >= 0.65::DOUBLE THEN 'High' WHEN prob >= 0.35::DOUBLE THEN 'Medium' ELSE 'Low' END
                       AS fixed_risk FROM p""",
        "customers",
        **_PROB,
    ),
)
def risk_band(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select(
        "customer_id", "risk", rules.fixed_risk_band(F.col("prob")).alias("fixed_risk")
    )


@query(
    "severity_band",
    sql(
        """SELECT seq, CASE WHEN s > 0.5::DOUBLE + 0.15::DOUBLE THEN 'High' WHEN s > 0.5::DOUBLE THEN 'Medium'
                            ELSE 'Normal' END AS severity FROM (
             SELECT seq, (aux - lo) / (hi - lo + 1e-9) AS s FROM tele,
                    (SELECT min(aux) AS lo, max(aux) AS hi FROM tele))""",
        "tele",
    ),
)
def severity_band(spark: SparkSession, folder: str) -> DataFrame:
    """Severity of a reading from a score scaled with stored limits, never with the row's own."""
    t = views.tele(spark, folder)
    scaled = stats.minmax_norm(t, stats.fit_minmax(t, ["aux"]), ["aux"])
    return scaled.select("seq", rules.severity_band(F.col("aux_norm"), 0.5).alias("severity"))


@query(
    "retention_action",
    sql(
        """SELECT customer_id,
             CASE WHEN contract_type = 'Month-to-month' THEN 'Offer 2-year contract discount'
                  WHEN tech_support_flag = 0 THEN 'Schedule proactive tech support call'
                  ELSE 'Review pricing plan options' END AS action,
             CASE WHEN prob >= 0.3::DOUBLE THEN
                  CASE WHEN contract_type = 'Month-to-month' THEN 'Offer: 2-year contract discount (-15%)'
                       WHEN tech_support_flag = 0 THEN 'Offer: Complimentary 3-month tech support trial'
                       ELSE 'Action: Proactive account manager call' END
                  ELSE 'No immediate action needed' END AS offer,
             CASE WHEN prob >= 0.65::DOUBLE THEN
                  CASE WHEN contract_type = 'Month-to-month' THEN 'Offer 2-year contract at 20% discount immediately'
                       ELSE 'Immediate account manager call + network SLA upgrade' END
                  WHEN prob >= 0.35::DOUBLE THEN 'Proactive check-in call + offer complimentary tech support'
                  ELSE 'Customer is stable - monitor network metrics monthly' END AS banded,
             CASE WHEN prob >= 0.65::DOUBLE THEN 'Offer contract upgrade'
                  WHEN prob >= 0.35::DOUBLE THEN 'Proactive tech support call' END AS short_action
           FROM p""",
        "customers",
        **_PROB,
    ),
)
def retention_action(spark: SparkSession, folder: str) -> DataFrame:
    prob = F.col("prob")
    return _scored(spark, folder).select(
        "customer_id",
        rules.retention_action().alias("action"),
        rules.offer_action(prob, 0.3).alias("offer"),
        rules.banded_action(prob).alias("banded"),
        rules.short_action(prob).alias("short_action"),
    )


@query(
    "top_reasons",
    sql(
        """SELECT customer_id, array_to_string(list_filter([
               CASE WHEN contract_type = 'Month-to-month' THEN 'Month-to-month contract (highest churn risk)' END,
               CASE WHEN tenure_months < 12 THEN 'Short tenure (' || tenure_months || ' months)' END,
               CASE WHEN monthly_charges > 80 THEN 'High monthly charges ($' || monthly_charges || ')' END,
               CASE WHEN tech_support_flag = 0 THEN 'No tech support subscription' END,
               CASE WHEN anomaly_count_30d > 100 THEN 'High network anomaly count (' || anomaly_count_30d || ' in 30d)' END,
               CASE WHEN wifi_breach_count_30d > 20 THEN 'Frequent Wi-Fi degradations (' || wifi_breach_count_30d || ' breaches)' END
             ], lambda x: x IS NOT NULL)[1:3], ' | ') AS reasons,
             array_to_string(list_filter([
               CASE WHEN contract_type = 'Month-to-month' THEN 'Month-to-month contract (highest risk)' END,
               CASE WHEN tenure_months < 12 THEN 'Short tenure (' || tenure_months || ' months — high early-churn window)' END,
               CASE WHEN anomaly_count_30d > 80 THEN anomaly_count_30d || ' HFC anomalies in last 30 days' END,
               CASE WHEN monthly_charges > 80 THEN 'High monthly charges ($' || monthly_charges || '/mo)' END,
               CASE WHEN wifi_breach_count_30d > 15 THEN wifi_breach_count_30d || ' Wi-Fi breaches in last 30 days' END,
               CASE WHEN days_since_last_anomaly < 7 THEN 'Network event only ' || days_since_last_anomaly || ' day(s) ago' END
             ], lambda x: x IS NOT NULL)[1:3], ' | ') AS rule_reasons
           FROM customers""",
        "customers",
    ),
)
def top_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return views.customers(spark, folder).select(
        "customer_id",
        F.array_join(rules.top_reasons(), " | ").alias("reasons"),
        F.array_join(rules.top_reasons_short_list(), " | ").alias("rule_reasons"),
    )


@query(
    "topk_risk",
    sql(
        f"SELECT customer_id, prob, {_BAND} AS risk FROM p ORDER BY prob DESC NULLS LAST, customer_id LIMIT 50",
        "customers",
        **_PROB,
    ),
)
def topk_risk(spark: SparkSession, folder: str) -> DataFrame:
    return stats.topk(_scored(spark, folder), "prob", 50, "customer_id").select("customer_id", "prob", "risk")


@query(
    "risk_filter",
    sql(
        f"""SELECT customer_id, prob, contract_type FROM p WHERE {_BAND} IN ('High', 'Medium') AND prob >= 0.4::DOUBLE
            AND contract_type IN ('Month-to-month', 'One year')""",
        "customers",
        **_PROB,
    ),
)
def risk_filter(spark: SparkSession, folder: str) -> DataFrame:
    keep = rules.risk_filter("risk", "prob", ["High", "Medium"], 0.4, ["Month-to-month", "One year"])
    return _scored(spark, folder).where(keep).select("customer_id", "prob", "contract_type")


@query(
    "risk_kpis",
    sql(
        f"""SELECT count(*) AS total, count(*) FILTER (WHERE {_BAND} = 'High') AS high,
                   count(*) FILTER (WHERE {_BAND} = 'Medium') AS medium, round(avg(prob), 6) AS mean_probability FROM p""",
        "customers",
        **_PROB,
    ),
)
def risk_kpis(spark: SparkSession, folder: str) -> DataFrame:
    kpis = stats.risk_kpis(_scored(spark, folder), "prob", "risk")
    return kpis.withColumn("mean_probability", r("mean_probability", 6))


@query(
    "risk_profile",
    sql(
        """SELECT customer_id, round(greatest(0, 100 - tenure_months * 1.8::DOUBLE), 4) AS axis_tenure,
                  round(least(100, anomaly_count_30d / 3), 4) AS axis_network,
                  round(least(100, monthly_charges / 1.2::DOUBLE), 4) AS axis_charges,
                  least(100, wifi_breach_count_30d * 3.0::DOUBLE) AS axis_wifi FROM customers""",
        "customers",
    ),
)
def risk_profile(spark: SparkSession, folder: str) -> DataFrame:
    axes = rules.risk_profile()
    return views.customers(spark, folder).select("customer_id", *[r(c, 4, n) for n, c in axes.items()])
