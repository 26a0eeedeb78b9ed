"""Bands, actions, reasons and additive risk scores as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from telequal.functions.numbers import steady_round

# Band limits, rule weights, limits and texts.
RISK_STEP = 0.20
SEVERITY_STEP = 0.15
FIXED_RISK_LIMITS = (0.35, 0.65)
STATUS_LIMITS = (55, 75)

# (column, test, operand, weight); the first row that holds per column counts.
LABEL_WEIGHTS = [
    ("contract_type", "=", "Month-to-month", 0.25),
    ("contract_type", "=", "One year", 0.08),
    ("tenure_months", "<", 12, 0.15),
    ("tenure_months", "<", 24, 0.06),
    ("monthly_charges", ">", 80, 0.08),
    ("payment_method", "=", "Electronic check", 0.06),
    ("tech_support_flag", "=", 0, 0.06),
    ("internet_service_type", "=", "Fiber optic", 0.04),
    ("days_since_last_anomaly", "<", 7, 0.04),
]
LABEL_SEVERITY_WEIGHT, LABEL_BREACH_DIVISOR, LABEL_BREACH_CAP = 0.12, 200, 0.10
FALLBACK_WEIGHTS = [
    ("contract_type", "=", "Month-to-month", 0.28),
    ("contract_type", "=", "One year", 0.09),
    ("tenure_months", "<", 6, 0.18),
    ("tenure_months", "<", 18, 0.09),
    ("monthly_charges", ">", 85, 0.10),
    ("monthly_charges", ">", 70, 0.05),
    ("payment_method", "=", "Electronic check", 0.07),
    ("tech_support_flag", "=", 0, 0.06),
    ("internet_service_type", "=", "Fiber optic", 0.04),
    ("days_since_last_anomaly", "<", 7, 0.06),
]
FALLBACK_BASE, FALLBACK_LIMITS = 0.04, (0.03, 0.97)
FALLBACK_ANOMALY, FALLBACK_BREACH = (300, 0.14), (80, 0.10)
# (column, missing value, pivot, sign, weight)
SIGNAL_WEIGHTS = [
    ("ds_snr_db", 38, 38, -1, 0.028),
    ("us_power_level_dbmv", 38, 50, 1, 0.014),
    ("ds_channel_utilization_pct", 55, 80, 1, 0.009),
]
SIGNAL_BASE, SIGNAL_LIMITS, SIGNAL_THRESHOLD = 0.11, (0.04, 0.97), 0.37
SEVERITY_CAP = 600

SUPPORT_ACTION = "Schedule proactive tech support call"
CONTRACT_ACTION = "Offer 2-year contract discount"
PRICING_ACTION = "Review pricing plan options"


def risk_band(prob: Column, threshold: float | Column) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(prob >= t + RISK_STEP, "High").when(prob >= t, "Medium").otherwise("Low")


def fixed_risk_band(prob: Column) -> Column:
    low, high = FIXED_RISK_LIMITS
    return F.when(prob >= high, "High").when(prob >= low, "Medium").otherwise("Low")


def severity_band(score: Column, threshold: float | Column) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(score > t + SEVERITY_STEP, "High").when(score > t, "Medium").otherwise("Normal")


def device_status(score: Column) -> Column:
    low, high = STATUS_LIMITS
    return F.when(score >= high, "good").when(score >= low, "fair").otherwise("poor")


def severity_score(count: Column, cap: int = SEVERITY_CAP) -> Column:
    return steady_round(F.least(count, F.lit(cap)) / F.lit(cap), 4)


def charge_per_tenure(charges: Column, tenure: Column) -> Column:
    return steady_round(charges / F.greatest(tenure, F.lit(1)), 4)


def power_delta(us: Column, ds: Column) -> Column:
    return steady_round(us - (ds + F.lit(38.0)), 3)


def _test(col: str, op: str, operand) -> Column:
    c = F.col(col)
    return {"=": c == operand, "<": c < operand, ">": c > operand}[op]


def _weighted(rules: list[tuple]) -> Column:
    by_col: dict[str, list[tuple]] = {}
    for rule in rules:
        by_col.setdefault(rule[0], []).append(rule)
    terms = []
    for items in by_col.values():
        chain = F.when(_test(*items[0][:3]), items[0][3])
        for item in items[1:]:
            chain = chain.when(_test(*item[:3]), item[3])
        terms.append(chain.otherwise(F.lit(0.0)))
    return reduce(add, terms)


def _bounded(x: Column, limits: tuple[float, float]) -> Column:
    return F.least(F.lit(limits[1]), F.greatest(F.lit(limits[0]), x))


def label_risk_score() -> Column:
    """Score behind the churn label, from customer and network columns."""
    return steady_round(
        _weighted(LABEL_WEIGHTS)
        + F.col("anomaly_severity_score") * LABEL_SEVERITY_WEIGHT
        + F.least(F.col("wifi_breach_count_30d") / LABEL_BREACH_DIVISOR, F.lit(LABEL_BREACH_CAP)),
        6,
    )


def fallback_risk_score() -> Column:
    """Rule score used where no model is at hand."""
    counts = F.least(F.col("anomaly_count_30d") / FALLBACK_ANOMALY[0], F.lit(FALLBACK_ANOMALY[1])) + F.least(
        F.col("wifi_breach_count_30d") / FALLBACK_BREACH[0], F.lit(FALLBACK_BREACH[1])
    )
    return _bounded(F.lit(FALLBACK_BASE) + _weighted(FALLBACK_WEIGHTS) + counts, FALLBACK_LIMITS)


def signal_risk_score(cols: dict[str, str] | None = None) -> Column:
    """Rule score of a modem reading; ``cols`` maps the standard names to other columns."""
    names = cols or {}
    terms = [
        F.greatest(
            F.lit(0.0), (F.coalesce(F.col(names.get(c, c)), F.lit(float(missing))) - pivot) * sign * weight
        )
        for c, missing, pivot, sign, weight in SIGNAL_WEIGHTS
    ]
    return _bounded(reduce(add, terms) + SIGNAL_BASE, SIGNAL_LIMITS)


def retention_action() -> Column:
    return (
        F.when(F.col("contract_type") == "Month-to-month", CONTRACT_ACTION)
        .when(F.col("tech_support_flag") == 0, SUPPORT_ACTION)
        .otherwise(PRICING_ACTION)
    )


def offer_action(prob: Column, threshold: float) -> Column:
    """Offer shown beside a scored customer; none below the threshold."""
    return F.when(
        prob >= threshold,
        F.when(F.col("contract_type") == "Month-to-month", "Offer: 2-year contract discount (-15%)")
        .when(F.col("tech_support_flag") == 0, "Offer: Complimentary 3-month tech support trial")
        .otherwise("Action: Proactive account manager call"),
    ).otherwise("No immediate action needed")


def banded_action(prob: Column) -> Column:
    low, high = FIXED_RISK_LIMITS
    return (
        F.when(
            prob >= high,
            F.when(
                F.col("contract_type") == "Month-to-month", "Offer 2-year contract at 20% discount immediately"
            ).otherwise("Immediate account manager call + network SLA upgrade"),
        )
        .when(prob >= low, "Proactive check-in call + offer complimentary tech support")
        .otherwise("Customer is stable - monitor network metrics monthly")
    )


def short_action(prob: Column) -> Column:
    low, high = FIXED_RISK_LIMITS
    return F.when(prob >= high, "Offer contract upgrade").when(prob >= low, "Proactive tech support call")


def _number(c: str) -> Column:
    return F.col(c).cast("string")


def _first_three(reasons: list[Column]) -> Column:
    return F.slice(F.filter(F.array(*reasons), lambda r: r.isNotNull()), 1, 3)


def top_reasons() -> Column:
    """The first three reasons that hold, in rule order."""
    return _first_three(
        [
            F.when(
                F.col("contract_type") == "Month-to-month", F.lit("Month-to-month contract (highest churn risk)")
            ),
            F.when(
                F.col("tenure_months") < 12,
                F.concat(F.lit("Short tenure ("), _number("tenure_months"), F.lit(" months)")),
            ),
            F.when(
                F.col("monthly_charges") > 80,
                F.concat(F.lit("High monthly charges ($"), _number("monthly_charges"), F.lit(")")),
            ),
            F.when(F.col("tech_support_flag") == 0, F.lit("No tech support subscription")),
            F.when(
                F.col("anomaly_count_30d") > 100,
                F.concat(F.lit("High network anomaly count ("), _number("anomaly_count_30d"), F.lit(" in 30d)")),
            ),
            F.when(
                F.col("wifi_breach_count_30d") > 20,
                F.concat(
                    F.lit("Frequent Wi-Fi degradations ("), _number("wifi_breach_count_30d"), F.lit(" breaches)")
                ),
            ),
        ]
    )


def top_reasons_short_list() -> Column:
    """Reasons of the rule score, with its own limits and a recency reason."""
    return _first_three(
        [
            F.when(F.col("contract_type") == "Month-to-month", F.lit("Month-to-month contract (highest risk)")),
            F.when(
                F.col("tenure_months") < 12,
                F.concat(
                    F.lit("Short tenure ("), _number("tenure_months"), F.lit(" months — high early-churn window)")
                ),
            ),
            F.when(
                F.col("anomaly_count_30d") > 80,
                F.concat(_number("anomaly_count_30d"), F.lit(" HFC anomalies in last 30 days")),
            ),
            F.when(
                F.col("monthly_charges") > 80,
                F.concat(F.lit("High monthly charges ($"), _number("monthly_charges"), F.lit("/mo)")),
            ),
            F.when(
                F.col("wifi_breach_count_30d") > 15,
                F.concat(_number("wifi_breach_count_30d"), F.lit(" Wi-Fi breaches in last 30 days")),
            ),
            F.when(
                F.col("days_since_last_anomaly") < 7,
                F.concat(
                    F.lit("Network event only "), _number("days_since_last_anomaly"), F.lit(" day(s) ago")
                ),
            ),
        ]
    )


def risk_profile() -> dict[str, Column]:
    """Risk axes on a 0 to 100 scale."""
    return {
        "axis_tenure": F.greatest(F.lit(0.0), F.lit(100.0) - F.col("tenure_months") * 1.8),
        "axis_network": F.least(F.lit(100.0), F.col("anomaly_count_30d") / 3),
        "axis_charges": F.least(F.lit(100.0), F.col("monthly_charges") / 1.2),
        "axis_wifi": F.least(F.lit(100.0), F.col("wifi_breach_count_30d") * 3.0),
    }


def risk_filter(risk: str, prob: str, levels: list[str], least: float, contracts: list[str]) -> Column:
    keep = F.col(risk).isin(levels) & (F.col(prob) >= least)
    return keep & F.col("contract_type").isin(contracts) if contracts else keep
