"""Registry of named queries, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telequal.functions.numbers import steady_round

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = steady_rounding(check)
        return fn

    return register


def r(col: str | Column, digits: int = 4, name: str | None = None) -> Column:
    """Rounded column under its own name, so that sums in another order still compare equal."""
    c = F.col(col) if isinstance(col, str) else col
    return steady_round(c, digits).alias(name or col)


def steady_rounding(text: str) -> str:
    """Round a 9-digit decimal in every ``round(x, n)`` of the checking SQL, as :func:`steady_round` does."""
    start = text.find("round(")
    if start < 0:
        return text
    depth, comma, end = 1, -1, start + len("round(")
    while depth:
        ch = text[end]
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 1:
            comma = end
        end += 1
    value, digits = text[start + len("round(") : comma], text[comma + 1 : end - 1]
    inner = f"CAST(ROUND(CAST({steady_rounding(value)} AS DECIMAL(38, 9)), {digits.strip()}) AS DOUBLE)"
    return text[:start] + inner + steady_rounding(text[end:])


# Shared views of the checking SQL; later ones may use earlier ones.
VIEWS = {
    "tele": """
        SELECT user_id AS entity, ts, event_id AS seq, event_type AS kind,
               CAST(100 AS DOUBLE) - value AS signal,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS aux,
               CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS flag
        FROM events""",
    "telen": """
        SELECT entity, ts, seq, kind,
               CASE WHEN signal BETWEEN -200 AND 100 THEN signal END AS signal,
               CASE WHEN aux BETWEEN 0 AND 95 THEN aux END AS aux, flag
        FROM tele""",
    "li": """
        SELECT l_orderkey, l_linenumber, l_partkey AS part, l_suppkey AS entity, l_shipdate AS ts,
               l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
               l_linestatus AS status, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS flag
        FROM lineitem""",
    "bounds": """
        SELECT (SELECT date_trunc('day', max(ts)) + INTERVAL 1 DAY FROM tele) AS until_ts,
               (SELECT date_trunc('day', max(ts)) - INTERVAL 14 DAY FROM tele) AS cutoff,
               (SELECT max(o_orderdate) FROM orders) AS horizon,
               (SELECT count(DISTINCT entity) FROM tele) AS n_users""",
    "network": """
        SELECT entity,
               CAST(coalesce(sum(flag) FILTER (WHERE ts >= (SELECT cutoff FROM bounds)), 0) AS BIGINT)
                   AS anomaly_count_30d,
               count(*) FILTER (WHERE aux > 90 AND ts >= (SELECT cutoff FROM bounds)) AS wifi_breach_count_30d,
               coalesce(CAST(floor((epoch_us((SELECT until_ts FROM bounds)) -
                   epoch_us(max(ts) FILTER (WHERE flag = 1 OR aux > 90))) / 86400000000) AS BIGINT), 90)
                   AS days_since_last_anomaly
        FROM tele GROUP BY entity""",
    "placed": """
        SELECT o_custkey, min(o_orderdate) AS first_order, avg(o_totalprice) AS mean_order,
               count(*) FILTER (WHERE o_orderstatus = 'P') AS calls,
               arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority
        FROM orders GROUP BY o_custkey""",
    "customers0": """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Month-to-month'
                    WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'One year' ELSE 'Two year' END AS contract_type,
               CASE priority WHEN '1-URGENT' THEN 'Electronic check' WHEN '2-HIGH' THEN 'Mailed check'
                    WHEN '3-MEDIUM' THEN 'Bank transfer' ELSE 'Credit card' END AS payment_method,
               CASE c_nationkey % 3 WHEN 0 THEN 'Fiber optic' WHEN 1 THEN 'DSL' ELSE 'No' END AS internet_service_type,
               CAST(floor(coalesce(date_diff('day', first_order, (SELECT horizon FROM bounds)), 0) / 30) AS BIGINT)
                   AS tenure_months,
               round(coalesce(mean_order, 0) / 4000, 2) AS monthly_charges,
               c_nationkey % 2 AS tech_support_flag,
               CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS paperless_billing_flag,
               coalesce(calls, 0) AS service_call_frequency_30d,
               coalesce(anomaly_count_30d, 0) AS anomaly_count_30d,
               coalesce(wifi_breach_count_30d, 0) AS wifi_breach_count_30d,
               coalesce(days_since_last_anomaly, 90) AS days_since_last_anomaly
        FROM customer LEFT JOIN placed ON o_custkey = c_custkey
             LEFT JOIN network ON entity = c_custkey % (SELECT n_users FROM bounds)""",
    "customers": """
        SELECT *, round(monthly_charges / greatest(tenure_months, 1), 4) AS charge_per_tenure_ratio,
               round(least(anomaly_count_30d * 20, 600) / 600, 4) AS anomaly_severity_score
        FROM customers0""",
    "scored": """
        SELECT *, round(
            CASE contract_type WHEN 'Month-to-month' THEN 0.25::DOUBLE WHEN 'One year' THEN 0.08::DOUBLE ELSE 0 END
            + CASE WHEN tenure_months < 12 THEN 0.15::DOUBLE WHEN tenure_months < 24 THEN 0.06::DOUBLE ELSE 0 END
            + CASE WHEN monthly_charges > 80 THEN 0.08::DOUBLE ELSE 0 END
            + CASE WHEN payment_method = 'Electronic check' THEN 0.06::DOUBLE ELSE 0 END
            + CASE WHEN tech_support_flag = 0 THEN 0.06::DOUBLE ELSE 0 END
            + CASE WHEN internet_service_type = 'Fiber optic' THEN 0.04::DOUBLE ELSE 0 END
            + CASE WHEN days_since_last_anomaly < 7 THEN 0.04::DOUBLE ELSE 0 END
            + anomaly_severity_score * 0.12::DOUBLE
            + least(wifi_breach_count_30d / 200, 0.10::DOUBLE), 6) AS risk_score
        FROM customers""",
    "crm": """
        SELECT *, CASE WHEN risk_score > (SELECT quantile_cont(risk_score, 0.74) FROM scored) THEN 1 ELSE 0 END AS churn
        FROM scored""",
    "hm": "SELECT kind AS series, date_trunc('hour', ts) AS ts, avg(signal) AS m FROM tele GROUP BY 1, 2",
    "hg": """
        SELECT series, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM hm GROUP BY series""",
    "hourly": """
        SELECT hg.series, hg.ts, last_value(hm.m IGNORE NULLS) OVER (
                   PARTITION BY hg.series ORDER BY hg.ts ROWS UNBOUNDED PRECEDING) AS y
        FROM hg LEFT JOIN hm ON hm.series = hg.series AND hm.ts = hg.ts""",
    "hme": "SELECT entity AS series, date_trunc('hour', ts) AS ts, avg(signal) AS m FROM tele GROUP BY 1, 2",
    "hge": """
        SELECT series, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM hme GROUP BY series""",
    "hourlye": """
        SELECT hge.series, hge.ts, last_value(hme.m IGNORE NULLS) OVER (
                   PARTITION BY hge.series ORDER BY hge.ts ROWS UNBOUNDED PRECEDING) AS y
        FROM hge LEFT JOIN hme ON hme.series = hge.series AND hme.ts = hge.ts""",
    "sf0": """
        SELECT series, ts, y, row_number() OVER w - 1 AS pos,
               row_number() OVER w - 1 < floor(count(*) OVER (PARTITION BY series) * 0.8::DOUBLE) AS train,
               lag(y, 24) OVER w AS y_season, y - lag(y, 24) OVER w AS z
        FROM hourly WINDOW w AS (PARTITION BY series ORDER BY ts)""",
    "sframe": """
        SELECT *, lag(z, 1) OVER w AS z1, lag(z, 24) OVER w AS zs
        FROM sf0 WINDOW w AS (PARTITION BY series ORDER BY ts)""",
    "moments": """
        SELECT series, count(*) AS n, sum(z1 * z1) AS s11, sum(zs * zs) AS s22, sum(z1 * zs) AS s12,
               sum(z * z1) AS b1, sum(z * zs) AS b2, sum(z * z) AS szz
        FROM sframe WHERE train AND z1 IS NOT NULL AND zs IS NOT NULL GROUP BY series""",
    "fit0": """
        SELECT *, (b1 * s22 - b2 * s12) / (s11 * s22 - s12 * s12) AS phi,
               (b2 * s11 - b1 * s12) / (s11 * s22 - s12 * s12) AS phi_season
        FROM moments""",
    "fit": """
        SELECT *, (szz - phi * b1 - phi_season * b2) / n AS sigma2,
               -n / 2 * (ln(2 * pi() * (szz - phi * b1 - phi_season * b2) / n) + 1) AS llf
        FROM fit0""",
    "fcast": """
        SELECT series, ts, pos, train, y AS actual, y_season + phi * z1 + phi_season * zs AS forecast
        FROM sframe JOIN fit USING (series) WHERE z1 IS NOT NULL AND zs IS NOT NULL""",
}
_NEEDS = {
    "telen": ["tele"],
    "bounds": ["tele"],
    "network": ["bounds"],
    "customers0": ["bounds", "network", "placed"],
    "customers": ["customers0"],
    "scored": ["customers"],
    "crm": ["scored"],
    "hm": ["tele"],
    "hg": ["hm"],
    "hourly": ["hg"],
    "hme": ["tele"],
    "hge": ["hme"],
    "hourlye": ["hge"],
    "sf0": ["hourly"],
    "sframe": ["sf0"],
    "moments": ["sframe"],
    "fit0": ["moments"],
    "fit": ["fit0"],
    "fcast": ["fit"],
}


def sql(body: str, *views: str, **extra: str) -> str:
    """Prefix ``body`` with the views it needs and with ``extra`` ones, in order."""
    wanted: list[str] = []

    def add(v: str) -> None:
        for need in _NEEDS.get(v, []):
            add(need)
        if v not in wanted:
            wanted.append(v)

    for v in views:
        add(v)
    parts = [f"{v} AS ({VIEWS[v]})" for v in wanted] + [f"{k} AS ({v})" for k, v in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
