"""Input schemas and fixed values of the three data sets (modem, Wi-Fi, customer)."""

from __future__ import annotations

from pyspark.sql import types as T

_D, _I, _S, _TS = T.DoubleType(), T.IntegerType(), T.StringType(), T.TimestampType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# Column names, order, valid ranges, domains and model settings that results must agree on.

MODEM_SCHEMA = _schema(
    timestamp=_TS,
    modem_id=_S,
    customer_id=_S,
    ds_power_level_dbmv=_D,
    us_power_level_dbmv=_D,
    ds_snr_db=_D,
    us_mer_db=_D,
    ds_channel_utilization_pct=_D,
    us_channel_utilization_pct=_D,
    ds_power_rolling_std_1h=_D,
    snr_drop_rate_per_hour=_D,
    us_ds_power_delta=_D,
    channel_util_peak_hour_flag=_I,
    anomaly_flag=_I,
)
MODEM_RANGES = {
    "ds_power_level_dbmv": (-15, 15),
    "us_power_level_dbmv": (30, 55),
    "ds_snr_db": (20, 50),
    "us_mer_db": (20, 48),
    "ds_channel_utilization_pct": (0, 100),
    "us_channel_utilization_pct": (0, 100),
}
MODEM_FEATURES = [
    "ds_power_level_dbmv",
    "us_power_level_dbmv",
    "ds_snr_db",
    "us_mer_db",
    "ds_channel_utilization_pct",
    "us_channel_utilization_pct",
    "ds_power_rolling_std_1h",
    "snr_drop_rate_per_hour",
    "us_ds_power_delta",
    "channel_util_peak_hour_flag",
]
MODEM_SIGNALS = [
    "ds_power_level_dbmv",
    "us_power_level_dbmv",
    "ds_snr_db",
    "us_mer_db",
    "ds_channel_utilization_pct",
    "us_channel_utilization_pct",
    "us_ds_power_delta",
]
MODEM_CAPPED = [
    "ds_power_level_dbmv",
    "us_power_level_dbmv",
    "ds_snr_db",
    "us_mer_db",
    "ds_power_rolling_std_1h",
    "snr_drop_rate_per_hour",
    "us_ds_power_delta",
]

WIFI_SCHEMA = _schema(
    timestamp=_TS,
    customer_id=_S,
    device_id=_S,
    device_type=_S,
    hour_of_day=_I,
    day_of_week=_I,
    wifi_experience_score=_D,
    rssi_dbm=_D,
    channel_interference_pct=_D,
    active_device_count=_I,
    experience_rolling_mean_7d=_D,
    experience_rolling_std_7d=_D,
    hfc_anomaly_flag=_I,
    forecast_breach_flag=_I,
)
WIFI_RANGES = {
    "wifi_experience_score": (0, 100),
    "rssi_dbm": (-90, -20),
    "channel_interference_pct": (0, 100),
    "active_device_count": (0, 50),
}
DEVICE_CODES = {"laptop": 0, "iot": 1}

CUSTOMER_SCHEMA = _schema(
    customer_id=_S,
    contract_type=_S,
    payment_method=_S,
    internet_service_type=_S,
    tenure_months=_I,
    monthly_charges=_D,
    charge_per_tenure_ratio=_D,
    tech_support_flag=_I,
    paperless_billing_flag=_I,
    service_call_frequency_30d=_I,
    anomaly_count_30d=_I,
    anomaly_severity_score=_D,
    wifi_breach_count_30d=_I,
    days_since_last_anomaly=_I,
    churn=_I,
)
CUSTOMER_RANGES = {
    "tenure_months": (0, 500),
    "monthly_charges": (0, 500),
    "service_call_frequency_30d": (0, 50),
    "anomaly_severity_score": (0, 1),
}
CONTRACTS = ["Month-to-month", "One year", "Two year"]
CUSTOMER_CATEGORIES = ["contract_type", "payment_method", "internet_service_type"]
CUSTOMER_NUMBERS = [
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
NETWORK_COLUMNS = [
    "anomaly_count_30d",
    "anomaly_severity_score",
    "wifi_breach_count_30d",
    "days_since_last_anomaly",
]
CHURN_FEATURES = [c for c in CUSTOMER_CATEGORIES + CUSTOMER_NUMBERS if c != "anomaly_severity_score"]
# Values assumed for fields a scoring request leaves out.
CUSTOMER_DEFAULTS = {
    "contract_type": "Month-to-month",
    "tenure_months": 12,
    "monthly_charges": 65.0,
    "payment_method": "Electronic check",
    "tech_support_flag": 0,
    "internet_service_type": "Fiber optic",
    "paperless_billing_flag": 1,
    "service_call_frequency_30d": 2,
    "charge_per_tenure_ratio": 5.0,
    "anomaly_count_30d": 0,
    "wifi_breach_count_30d": 0,
    "days_since_last_anomaly": 90,
}

MODEM_DEFAULTS = {
    "ds_power_level_dbmv": 0.5,
    "us_power_level_dbmv": 38.0,
    "ds_snr_db": 38.0,
    "us_mer_db": 36.0,
    "ds_channel_utilization_pct": 55.0,
    "us_channel_utilization_pct": 40.0,
    "ds_power_rolling_std_1h": 0.1,
    "snr_drop_rate_per_hour": 0.0,
    "us_ds_power_delta": 0.0,
    "channel_util_peak_hour_flag": 0,
}
WIFI_DEFAULTS = {
    "wifi_experience_score": 75.0,
    "rolling_mean_7d": 75.0,
    "rolling_std_7d": 5.0,
    "sigma_threshold": 3.0,
}

IF_TREES, IF_SAMPLE, LOF_NEIGHBOURS = 200, 256, 20
IF_WEIGHT, LOF_WEIGHT = 0.60, 0.40
ANOMALY_SHARE = 0.88
ROLLING_ROWS = 4
BASELINE_ROWS, BASELINE_MIN_ROWS, SIGMAS = 168, 24, 3.0
SEASON = 24
TRAIN_SHARE = 0.80
TEST_SIZE, VALIDATION_SIZE = 0.20, 0.15
HIDDEN_LAYERS = [128, 64, 32]
HORIZON_DAYS, TRAILING_DAYS = 90, 30
