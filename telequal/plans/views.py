"""The analytic views over the base tables: telemetry, line items, customers, hourly series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telequal.functions.calendar import days_between
from telequal.functions.numbers import steady_round
from telequal.functions.rules import charge_per_tenure, label_risk_score, severity_score
from telequal.operators.ordered import instant
from telequal.operators.signals import enrich_left_default, last_event, recency_days, trailing_event_count
from telequal.operators.stats import percentile_label
from telequal.session import durable
from telequal.sources.tables import table

# Fixed values shared with the checking SQL.
TELE_RANGE = (-200, 100)
AUX_BREACH = 90


def tele(spark: SparkSession, folder: str) -> DataFrame:
    """Readings per entity; the signal falls as the raw value grows."""
    e = table(spark, folder, "events")
    return e.select(
        F.col("user_id").alias("entity"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("kind"),
        (F.lit(100.0) - F.col("value")).alias("signal"),
        F.get_json_object("props", "$.k").cast("double").alias("aux"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("flag"),
    )


def tele_nulled(spark: SparkSession, folder: str) -> DataFrame:
    """Telemetry with out-of-range cells nulled: signal outside its range, aux above 95."""
    lo, hi = TELE_RANGE
    return tele(spark, folder).withColumns(
        {
            "signal": F.when(F.col("signal").between(lo, hi), F.col("signal")),
            "aux": F.when(F.col("aux").between(0, 95), F.col("aux")),
        }
    )


def li(spark: SparkSession, folder: str) -> DataFrame:
    x = table(spark, folder, "lineitem")
    return x.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("entity"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_linestatus").alias("status"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("flag"),
    )


LI_SIGNALS = ["quantity", "price", "discount", "tax"]


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customer snapshot before the label: CRM columns plus network signals."""
    c, o, t = table(spark, folder, "customer"), table(spark, folder, "orders"), tele(spark, folder)
    last_day = F.date_trunc("day", F.max("ts"))
    span = t.agg(
        F.unix_micros(last_day + F.expr("interval 1 day")).alias("until"),
        F.unix_micros(last_day - F.expr("interval 14 day")).alias("cutoff"),
        F.countDistinct("entity").alias("n_users"),
    ).first()
    until, cutoff = instant(span["until"]), instant(span["cutoff"])
    horizon = instant(o.agg(F.unix_micros(F.max("o_orderdate").cast("timestamp"))).first()[0])
    placed = F.col("o_orderdate").cast("timestamp")
    latest = F.struct("o_orderdate", "o_orderkey")
    by_customer = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min(placed).alias("first_order"),
        F.avg("o_totalprice").alias("mean_order"),
        F.count_if(F.col("o_orderstatus") == "P").alias("calls"),
        F.max_by("o_orderpriority", latest).alias("priority"),
    )
    breach = t.withColumn("breach", F.when(F.col("aux") > AUX_BREACH, 1).otherwise(0))
    users = t.select("entity").distinct()
    network = recency_days(
        users,
        "entity",
        [
            last_event(t, "entity", "ts", "flag", "last_anomaly"),
            last_event(breach, "entity", "ts", "breach", "last_breach"),
        ],
        until,
        "days_since_last_anomaly",
    )
    network = enrich_left_default(
        network,
        trailing_event_count(t, "entity", "ts", "flag", cutoff, "anomaly_count_30d"),
        "entity",
        {"anomaly_count_30d": 0},
    )
    network = enrich_left_default(
        network,
        trailing_event_count(breach, "entity", "ts", "breach", cutoff, "wifi_breach_count_30d"),
        "entity",
        {"wifi_breach_count_30d": 0},
    )
    nation = F.col("c_nationkey")
    base = (
        c.join(by_customer, "c_custkey", "left")
        .withColumn("entity", F.pmod(F.col("c_custkey"), F.lit(span["n_users"])))
        .join(network, "entity", "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), "Month-to-month")
            .when(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD"), "One year")
            .otherwise("Two year")
            .alias("contract_type"),
            F.when(F.col("priority") == "1-URGENT", "Electronic check")
            .when(F.col("priority") == "2-HIGH", "Mailed check")
            .when(F.col("priority") == "3-MEDIUM", "Bank transfer")
            .otherwise("Credit card")
            .alias("payment_method"),
            F.when(nation % 3 == 0, "Fiber optic").when(nation % 3 == 1, "DSL").otherwise("No").alias(
                "internet_service_type"
            ),
            F.floor(F.coalesce(days_between(horizon, F.col("first_order")), F.lit(0)) / 30).alias("tenure_months"),
            steady_round(F.coalesce(F.col("mean_order"), F.lit(0.0)) / 4000, 2).alias("monthly_charges"),
            (nation % 2).alias("tech_support_flag"),
            F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("paperless_billing_flag"),
            F.coalesce("calls", F.lit(0).cast("bigint")).alias("service_call_frequency_30d"),
            F.coalesce("anomaly_count_30d", F.lit(0).cast("bigint")).alias("anomaly_count_30d"),
            F.coalesce("wifi_breach_count_30d", F.lit(0).cast("bigint")).alias("wifi_breach_count_30d"),
            F.coalesce("days_since_last_anomaly", F.lit(90).cast("bigint")).alias("days_since_last_anomaly"),
        )
    )
    return base.withColumns(
        {
            "charge_per_tenure_ratio": charge_per_tenure(F.col("monthly_charges"), F.col("tenure_months")),
            "anomaly_severity_score": severity_score(F.col("anomaly_count_30d") * 20),
        }
    )


def crm(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with the rule score and the label it implies (top 26 percent)."""
    # One row per customer, read several times by the percentile and its users: written once.
    scored = durable(customers(spark, folder).withColumn("risk_score", label_risk_score()))
    return percentile_label(scored, "risk_score", 0.74, "churn")


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    """(series, ts, y) on a full hour grid per series, gaps carried forward.

    Rows per series are bounded by the hours of the horizon, not by the data.
    """
    from telequal.operators.forecast import hour_grid

    return hour_grid(tele(spark, folder), "kind", "ts", "signal")


def hourly_entities(spark: SparkSession, folder: str) -> DataFrame:
    """The same grid for every single entity: as many series as there are entities."""
    from telequal.operators.forecast import hour_grid

    return hour_grid(tele(spark, folder), "entity", "ts", "signal")
