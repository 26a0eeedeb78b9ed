"""Preparation of the three data sets from raw tables to model-ready splits, with their reports.

Every function returns (split rows, report); the split rows are written once to the shared folder
because fits and writers read them several times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telequal.functions.calendar import calendar_features
from telequal.functions.rules import power_delta
from telequal.operators import dedup, encode, features, impute, outliers, quality, split, stats
from telequal.operators.panel import MAX_ENTITY_ROWS, measure
from telequal.schemas import (
    CONTRACTS,
    CUSTOMER_CATEGORIES,
    CUSTOMER_NUMBERS,
    CUSTOMER_RANGES,
    CUSTOMER_SCHEMA,
    DEVICE_CODES,
    MODEM_CAPPED,
    MODEM_RANGES,
    MODEM_SCHEMA,
    MODEM_SIGNALS,
    NETWORK_COLUMNS,
    WIFI_RANGES,
    WIFI_SCHEMA,
)
from telequal.session import durable

WIFI_CAPPED = ["wifi_experience_score", "rssi_dbm", "channel_interference_pct", "active_device_count"]


def _panel_report(
    raw: DataFrame,
    ranged: DataFrame,
    ranges: dict,
    keys: Sequence[str],
    capped: DataFrame,
    parts: DataFrame,
    label: str,
    entity: str,
) -> DataFrame:
    whole = F.lit("all").alias("column")
    copies = dedup.dedup_report(raw, keys).select("*", whole)
    return quality.quality_report(
        [
            quality.report_rows(quality.range_audit(raw, ranges), "range", "column", ["n_bad"]),
            quality.report_rows(quality.null_audit(ranged), "null", "column", ["n_null", "pct"]),
            quality.report_rows(copies, "dedup", "column", ["exact_rows", "key_duplicates", "rows_after"]),
            quality.report_rows(capped, "cap", "column", ["lower", "upper", "n_capped"]),
            quality.report_rows(
                split.split_summary(parts, label, entity), "split", "split", ["n_rows", "label_rate", "n_entities"]
            ),
        ]
    )


def prepare_modems(raw: DataFrame, max_entity_rows: int = MAX_ENTITY_ROWS) -> tuple[DataFrame, DataFrame]:
    """Modem readings: check, repair, cap on normal rows, recompute features, split by time."""
    entity, ts, label = "modem_id", "timestamp", "anomaly_flag"
    typed = quality.nan_to_null(quality.coerce_schema(raw, MODEM_SCHEMA))
    layout = measure(typed, entity, (ts,), max_entity_rows)
    ranged = quality.null_out_of_range(typed, MODEM_RANGES)
    unique = dedup.keep_last(ranged, [entity, ts], [F.xxhash64(*ranged.columns)])
    zeros = {c: 0.0 for c in ("ds_power_rolling_std_1h", "snr_drop_rate_per_hour")}
    zeros |= {"channel_util_peak_hour_flag": 0, label: 0}
    filled = durable(impute.impute_chain(unique, layout, MODEM_SIGNALS, constants=zeros))
    bounds = durable(outliers.iqr_bounds(filled, MODEM_CAPPED, label))
    clean = outliers.iqr_cap(filled, bounds, MODEM_CAPPED)
    clean = features.rolling_std(clean, layout, "ds_power_level_dbmv", "ds_power_rolling_std_1h")
    clean = features.rolling_rate(clean, layout, "ds_snr_db", "snr_drop_rate_per_hour")
    clean = clean.withColumn(
        "us_ds_power_delta", power_delta(F.col("us_power_level_dbmv"), F.col("ds_power_level_dbmv"))
    )
    parts = durable(split.time_split(durable(clean), ts))
    capped = outliers.cap_summary(filled, bounds, MODEM_CAPPED)
    return parts, _panel_report(typed, ranged, MODEM_RANGES, [entity, ts], capped, parts, label, entity)


def prepare_wifi(raw: DataFrame, max_entity_rows: int = MAX_ENTITY_ROWS) -> tuple[DataFrame, DataFrame]:
    """Device readings: check, repair, encode, cap, seasonal features and 7-day baseline, split by time."""
    entity, ts, label = "device_id", "timestamp", "forecast_breach_flag"
    typed = quality.nan_to_null(quality.coerce_schema(raw, WIFI_SCHEMA, zero_ints=True))
    layout = measure(typed, entity, (ts,), max_entity_rows)
    ranged = quality.null_out_of_range(typed, WIFI_RANGES)
    unique = dedup.keep_last(ranged, [entity, ts], [F.xxhash64(*ranged.columns)])
    filled = durable(
        impute.impute_chain(
            unique,
            layout,
            ["wifi_experience_score", "rssi_dbm"],
            "device_type",
            ["channel_interference_pct"],
            {
                "active_device_count": 1,
                "experience_rolling_mean_7d": 0.0,
                "experience_rolling_std_7d": 1.0,
                "hfc_anomaly_flag": 0,
                label: 0,
            },
        )
    )
    bounds = durable(outliers.iqr_bounds(filled, WIFI_CAPPED, label))
    coded = filled.withColumn("device_type_encoded", encode.map_encode("device_type", DEVICE_CODES))
    clean = outliers.iqr_cap(coded, bounds, WIFI_CAPPED)
    clean = features.rolling_baseline(
        clean, layout, "wifi_experience_score", "experience_rolling_mean_7d", "experience_rolling_std_7d"
    )
    bound = features.lower_bound("experience_rolling_mean_7d", "experience_rolling_std_7d")
    clean = clean.withColumns(calendar_features(ts)).withColumn("breach_lower_bound", F.round(bound, 3))
    parts = durable(split.time_split(durable(clean), ts))
    capped = outliers.cap_summary(filled, bounds, WIFI_CAPPED)
    return parts, _panel_report(typed, ranged, WIFI_RANGES, [entity, ts], capped, parts, label, entity)


def prepare_customers(
    raw: DataFrame, order: Column | None = None, updated: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Customer rows: rules, repair, one row per customer, stratified split.

    ``updated`` names a column that tells which of several rows of a customer is the last.
    """
    typed = quality.nan_to_null(quality.coerce_schema(raw, CUSTOMER_SCHEMA, zero_ints=True))
    domains = {"contract_type": CONTRACTS, "churn": [0, 1]}
    valid = quality.drop_rule_violations(typed, CUSTOMER_RANGES, domains)
    filled = durable(
        impute.impute_customers(durable(valid), NETWORK_COLUMNS, CUSTOMER_NUMBERS, CUSTOMER_CATEGORIES)
    )
    latest = [updated] if updated else []
    unique = durable(dedup.keep_last(filled, ["customer_id"], [*latest, F.xxhash64(*filled.columns)]))
    parts = durable(split.stratified_split(unique, "churn", order if order is not None else split.hashed("customer_id")))
    balance = split.class_balance(unique, "churn").select("*", F.lit("churn").alias("column"))
    copies = dedup.dedup_report(filled, ["customer_id"]).select("*", F.lit("all").alias("column"))
    numbers = stats.corr_target(unique, CUSTOMER_NUMBERS, "churn")
    report = quality.quality_report(
        [
            quality.report_rows(quality.rule_violations(typed, CUSTOMER_RANGES, domains), "rule", "rule", ["n_bad"]),
            quality.report_rows(quality.null_audit(valid), "null", "column", ["n_null", "pct"]),
            quality.report_rows(copies, "dedup", "column", ["exact_rows", "key_duplicates", "rows_after"]),
            quality.report_rows(balance, "balance", "column", ["n_pos", "n_neg", "pos_rate", "pos_weight"]),
            quality.report_rows(numbers, "correlation", "column", ["r"]),
            quality.report_rows(
                split.split_summary(parts, "churn", "customer_id"), "split", "split", ["n_rows", "label_rate"]
            ),
        ]
    )
    return parts, report
