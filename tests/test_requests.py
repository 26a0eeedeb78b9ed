"""Defaults, errors and limits of single scoring requests."""

from __future__ import annotations

from telequal.operators import requests
from telequal.schemas import MODEM_DEFAULTS, MODEM_FEATURES, WIFI_DEFAULTS


def test_defaults_cover_the_model_features():
    assert list(MODEM_DEFAULTS) == MODEM_FEATURES


def test_requests_take_defaults_and_name_bad_fields(spark):
    df = spark.createDataFrame([(1, "12.5"), (2, None), (3, "many"), (4, "NaN"), (5, "1e400")], "id int, wifi_experience_score string")
    got = {r.id: r for r in requests.completed(df, WIFI_DEFAULTS).collect()}
    assert (got[1].wifi_experience_score, got[1].rolling_mean_7d, got[1].sigma_threshold) == (12.5, 75.0, 3.0)
    assert got[2].wifi_experience_score == 75.0 and got[1].error is None and got[2].error is None
    assert {got[i].error for i in (3, 4, 5)} == {"wifi_experience_score is not a valid number"}
    assert requests.completed(df.limit(0), WIFI_DEFAULTS).count() == 0


def test_every_request_has_its_own_limit(spark):
    rows = [(1, 60.0, 2.9), (2, 60.0, 3.1), (3, 60.0, None), (4, None, 0.0)]
    df = spark.createDataFrame(rows, "id int, wifi_experience_score double, sigma_threshold double")
    got = {r.id: r for r in requests.score_wifi_requests(df).collect()}
    assert [got[i].is_breach for i in (1, 2, 3, 4)] == [True, False, False, False]
    assert [got[i].lower_bound for i in (1, 2, 3, 4)] == [60.5, 59.5, 60.0, 75.0]
    assert got[1].deviation_sigmas == 3.0 and got[3].sigma_threshold == 3.0
