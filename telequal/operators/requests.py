"""Scoring requests: fields that a caller leaves out get defaults, unreadable ones an error, and no row is lost."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telequal.functions.numbers import steady_round
from telequal.operators.features import deviation_sigmas, lower_bound
from telequal.schemas import WIFI_DEFAULTS


def completed(requests: DataFrame, defaults: Mapping[str, float], types: Mapping[str, str] | None = None) -> DataFrame:
    """``requests`` with every field of ``defaults`` as a number, and an ``error`` text or null.

    An absent column and a null take the default; a value that is no finite number stays null and names itself in ``error``,
    the first one of the row.  Numbers are doubles unless ``types`` says otherwise.
    """
    filled: dict[str, Column] = {}
    problems: list[Column] = []
    for name, default in defaults.items():
        kind = (types or {}).get(name, "double")
        standard = F.lit(default).cast(kind)
        if name not in requests.columns:
            filled[name] = standard
            continue
        value = F.col(name).try_cast("double")
        value = F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value).try_cast(kind)
        problems.append(F.when(F.col(name).isNotNull() & value.isNull(), F.lit(f"{name} is not a valid number")))
        filled[name] = F.when(F.col(name).isNull(), standard).otherwise(value)
    error = F.coalesce(*problems) if problems else F.lit(None).cast("string")
    return requests.withColumn("error", error).withColumns(filled)


def score_wifi_requests(requests: DataFrame) -> DataFrame:
    """Breach of each reading against its own baseline and its own number of deviations.

    Columns: those of ``requests`` that are no fields, then ``is_breach``, ``current_score``, ``lower_bound``,
    ``deviation_sigmas``, ``sigma_threshold`` and ``error``; a request with an error has nulls.
    """
    full = completed(requests, WIFI_DEFAULTS)
    mean, std, own = "rolling_mean_7d", "rolling_std_7d", F.col("wifi_experience_score")
    bound = lower_bound(mean, std, F.col("sigma_threshold"))
    ok = F.col("error").isNull()
    return full.select(
        *[c for c in requests.columns if c not in WIFI_DEFAULTS],
        F.when(ok, own < bound).alias("is_breach"),
        F.when(ok, own).alias("current_score"),
        F.when(ok, steady_round(bound, 2)).alias("lower_bound"),
        F.when(ok, steady_round(deviation_sigmas("wifi_experience_score", mean, std), 2)).alias("deviation_sigmas"),
        F.when(ok, F.col("sigma_threshold")).alias("sigma_threshold"),
        "error",
    )
