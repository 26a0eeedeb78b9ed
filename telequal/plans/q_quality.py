"""Queries: scans, checks, imputation, deduplication, capping and encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telequal.operators import dedup, encode, features, impute, outliers, quality, split, stats
from telequal.operators.panel import forward_fill, measure
from telequal.plans import views
from telequal.plans.registry import query, r, sql
from telequal.session import durable, scratch_path
from telequal.sources import sinks, tables

KINDS = ["error", "purchase"]
ORDER = ("ts", "seq")


def panel(df: DataFrame):
    return measure(df, "entity", ORDER)


@query("scan_project", "SELECT event_id, ts, value FROM events")
def scan_project(spark: SparkSession, folder: str) -> DataFrame:
    return tables.scan(spark, f"{folder}/events.parquet", ["event_id", "ts", "value"])


@query(
    "scan_pushdown_in",
    "SELECT event_id, user_id, value FROM events WHERE event_type IN ('error', 'purchase')",
)
def scan_pushdown_in(spark: SparkSession, folder: str) -> DataFrame:
    e = tables.table(spark, folder, "events")
    return tables.only_keys(e, "event_type", KINDS).select("event_id", "user_id", "value")


@query(
    "load_summary",
    """SELECT 'events' AS "table", count(*) AS n_rows, 6 AS n_columns,
              round(avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0 END), 4) AS label_rate FROM events
       UNION ALL
       SELECT 'lineitem', count(*), 11, round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END), 4)
       FROM lineitem
       UNION ALL
       SELECT 'orders', count(*), 6, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0 END), 4)
       FROM orders""",
)
def load_summary(spark: SparkSession, folder: str) -> DataFrame:
    labels = [
        ("events", F.col("event_type") == "error"),
        ("lineitem", F.col("l_returnflag") == "R"),
        ("orders", F.col("o_orderstatus") == "F"),
    ]
    parts = [
        stats.load_summary(tables.table(spark, folder, n), n, hit.cast("int")) for n, hit in labels
    ]
    return split.union_sources(*parts).withColumn("label_rate", r("label_rate"))


@query(
    "partitioned_roundtrip",
    """SELECT event_id, user_id, value, CAST(date_trunc('day', ts) AS DATE) AS date FROM events""",
)
def partitioned_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "events-by-date")
    e = tables.table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for _ in range(2):  # a rerun must leave one copy
        sinks.write_by_date(e, path, "ts")
    return tables.scan(spark, path, ["event_id", "user_id", "value", "date"])


@query(
    "records_json",
    sql(
        """SELECT seq, kind, CAST(aux AS BIGINT) AS aux, strftime(ts, '%Y-%m-%d %H') AS hour
           FROM tele""",
        "tele",
    ),
)
def records_json(spark: SparkSession, folder: str) -> DataFrame:
    """Records as JSON text, read back to show that nothing is lost."""
    t = views.tele(spark, folder)
    rec = sinks.records_json(t.select("seq", "kind", "aux", "ts"))
    back = F.from_json("record", "seq bigint, kind string, aux double, ts string")
    return rec.select(back.alias("b")).select(
        "b.seq", "b.kind", F.col("b.aux").cast("bigint").alias("aux"), F.substring("b.ts", 1, 13).alias("hour")
    )


@query(
    "metrics_flatten",
    sql(
        """SELECT 'kind-' || kind AS name, round(avg(aux) / 100, 4) AS threshold,
                  0.0::DOUBLE AS roc_auc, 0.0::DOUBLE AS avg_prec,
                  round(avg(flag), 4) AS precision, round(avg(CASE WHEN signal > 50 THEN 1 ELSE 0 END), 4) AS recall,
                  0.0::DOUBLE AS f1
           FROM tele GROUP BY kind""",
        "tele",
    ),
)
def metrics_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """Two metric layouts (top level and nested) are written as JSON and read as one flat table."""
    m = views.tele(spark, folder).groupBy("kind").agg(
        r(F.avg("aux") / 100, 4, "t"),
        r(F.avg("flag"), 4, "p"),
        r(F.avg(F.when(F.col("signal") > 50, 1).otherwise(0)), 4, "q"),
    )
    name = F.concat(F.lit("kind-"), "kind").alias("name")
    flat = F.struct(name, F.col("t").alias("threshold"), F.col("p").alias("precision"), F.col("q").alias("recall"))
    nested = F.struct(
        name,
        F.struct(F.col("t").alias("value")).alias("threshold"),
        F.struct(F.col("p").alias("precision"), F.col("q").alias("recall")).alias("evaluation"),
    )
    text = F.when(F.col("kind") < "m", F.to_json(flat)).otherwise(F.to_json(nested))
    return tables.parse_metrics(m.select(text.alias("json")), "json")


TEXT_EVENTS = """SELECT event_id, props AS value, json_extract_string(props, '$.k') AS k, event_type AS kind FROM events"""


def _text_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events whose numbers arrive as text, some of it unreadable."""
    e = tables.table(spark, folder, "events")
    k = F.get_json_object("props", "$.k")
    return e.select(
        "event_id",
        F.when(F.col("event_type") == "view", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        F.when(F.col("event_type") == "click", F.lit("x")).otherwise(k).alias("k"),
    )


TEXT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("k", T.LongType()),
        T.StructField("rssi", T.DoubleType()),
    ]
)


@query(
    "coerce_schema",
    """SELECT event_id, CASE WHEN event_type <> 'view' THEN value END AS value,
              CASE WHEN event_type <> 'click' THEN json_extract_string(props, '$.k') END AS k
       FROM events""",
)
def coerce_schema(spark: SparkSession, folder: str) -> DataFrame:
    out = quality.coerce_schema(_text_events(spark, folder), TEXT_SCHEMA)
    return out.withColumn("k", F.col("k").cast("string"))


@query(
    "coerce_schema_zero",
    """SELECT event_id, CASE WHEN event_type <> 'view' THEN value END AS value,
              CASE WHEN event_type <> 'click' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) ELSE 0 END AS k
       FROM events""",
)
def coerce_schema_zero(spark: SparkSession, folder: str) -> DataFrame:
    return quality.coerce_schema(_text_events(spark, folder), TEXT_SCHEMA, zero_ints=True)


@query(
    "schema_audit",
    """SELECT 'value' AS "column", 'cast' AS issue, 'double' AS expected, 'string' AS actual,
              count(*) AS rows, count(*) FILTER (WHERE event_type = 'view') AS failed FROM events
       UNION ALL
       SELECT 'k', 'cast', 'bigint', 'string', count(*), count(*) FILTER (WHERE event_type = 'click') FROM events
       UNION ALL
       SELECT 'rssi', 'missing', 'double', NULL, count(*), 0 FROM events""",
)
def schema_audit(spark: SparkSession, folder: str) -> DataFrame:
    return quality.schema_audit(_text_events(spark, folder), TEXT_SCHEMA)


RANGES = {"signal": (-200, 100), "aux": (0, 95)}


@query("range_null", sql("SELECT seq, signal, aux FROM telen", "telen"))
def range_null(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_out_of_range(views.tele(spark, folder), RANGES).select("seq", "signal", "aux")


@query(
    "range_audit",
    sql(
        """SELECT * FROM (
             SELECT 'signal' AS "column", count(*) FILTER (WHERE signal < -200 OR signal > 100) AS n_bad FROM tele
             UNION ALL SELECT 'aux', count(*) FILTER (WHERE aux < 0 OR aux > 95) FROM tele) WHERE n_bad > 0""",
        "tele",
    ),
)
def range_audit(spark: SparkSession, folder: str) -> DataFrame:
    return quality.range_audit(views.tele(spark, folder), RANGES)


@query(
    "rule_drop_range",
    sql(
        """SELECT seq, entity, aux FROM telen
           WHERE NOT coalesce(aux < 10 OR aux > 90, false)""",
        "telen",
    ),
)
def rule_drop_range(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele_nulled(spark, folder)
    return quality.drop_rule_violations(t, {"aux": (10, 90)}).select("seq", "entity", "aux")


# A category with gaps, so that null handling shows.
_GAPPED = "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END"


def _gapped_orders(spark: SparkSession, folder: str) -> DataFrame:
    o = tables.table(spark, folder, "orders")
    return o.withColumn(
        "priority", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    ).withColumn("label", F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0).otherwise(2))


@query(
    "rule_drop_domain",
    f"""SELECT o_orderkey, count(*) AS n FROM orders
        WHERE coalesce({_GAPPED} IN ('1-URGENT', '2-HIGH', '3-MEDIUM'), false) GROUP BY o_orderkey""",
)
def rule_drop_domain(spark: SparkSession, folder: str) -> DataFrame:
    kept = quality.drop_rule_violations(
        _gapped_orders(spark, folder), domains={"priority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}
    )
    return kept.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "rule_violations",
    f"""SELECT rule, count(*) AS n_bad FROM (
          SELECT CASE WHEN o_totalprice < 5000 OR o_totalprice > 400000 THEN 'o_totalprice'
                      WHEN NOT coalesce({_GAPPED} IN ('1-URGENT', '2-HIGH', '3-MEDIUM'), false) THEN 'priority'
                      WHEN o_orderstatus = 'P' THEN 'label' END AS rule
          FROM orders) WHERE rule IS NOT NULL GROUP BY rule""",
)
def rule_violations(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rule_violations(
        _gapped_orders(spark, folder),
        {"o_totalprice": (5000, 400000)},
        {"priority": ["1-URGENT", "2-HIGH", "3-MEDIUM"], "label": [0, 1]},
    )


@query(
    "null_audit",
    sql(
        """SELECT 'signal' AS "column", count(*) FILTER (WHERE signal IS NULL) AS n_null,
                  round(count(*) FILTER (WHERE signal IS NULL) / count(*) * 100, 4) AS pct FROM telen
           UNION ALL SELECT 'aux', count(*) FILTER (WHERE aux IS NULL),
                  round(count(*) FILTER (WHERE aux IS NULL) / count(*) * 100, 4) FROM telen
           UNION ALL SELECT 'kind', 0, 0.0 FROM (SELECT count(*) FROM telen)""",
        "telen",
    ),
)
def null_audit(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.null_audit(views.tele_nulled(spark, folder), ["signal", "aux", "kind"])
    return found.withColumn("pct", r("pct"))


@query(
    "const_fill",
    sql("SELECT seq, coalesce(signal, 0) AS signal, coalesce(aux, 1) AS aux FROM telen", "telen"),
)
def const_fill(spark: SparkSession, folder: str) -> DataFrame:
    return impute.constant_fill(views.tele_nulled(spark, folder), {"signal": 0.0, "aux": 1.0}).select(
        "seq", "signal", "aux"
    )


@query(
    "median_fill",
    sql(
        """SELECT seq, round(coalesce(signal, (SELECT quantile_cont(signal, 0.5) FROM telen)), 4) AS signal,
                  round(coalesce(aux, (SELECT quantile_cont(aux, 0.5) FROM telen)), 4) AS aux FROM telen""",
        "telen",
    ),
)
def median_fill(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele_nulled(spark, folder)
    return impute.median_fill(t, ["signal", "aux"]).select("seq", r("signal"), r("aux"))


@query(
    "group_median_fill",
    sql(
        """SELECT seq, round(coalesce(signal, ms), 4) AS signal, round(coalesce(aux, ma), 4) AS aux
           FROM telen JOIN (SELECT kind, quantile_cont(signal, 0.5) AS ms, quantile_cont(aux, 0.5) AS ma
                            FROM telen GROUP BY kind) USING (kind)""",
        "telen",
    ),
)
def group_median_fill(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele_nulled(spark, folder)
    return impute.group_median_fill(t, ["signal", "aux"], "kind").select("seq", r("signal"), r("aux"))


@query(
    "mode_fill",
    f"""SELECT o_orderkey, o_custkey, o_totalprice, coalesce({_GAPPED}, (
          SELECT p FROM (SELECT {_GAPPED} AS p, count(*) AS n FROM orders GROUP BY 1)
          WHERE p IS NOT NULL ORDER BY n DESC, p LIMIT 1)) AS priority FROM orders""",
)
def mode_fill(spark: SparkSession, folder: str) -> DataFrame:
    return impute.mode_fill(_gapped_orders(spark, folder), ["priority"]).select(
        "o_orderkey", "o_custkey", "o_totalprice", "priority"
    )


_FFILL = (
    "last_value({c} IGNORE NULLS) OVER (PARTITION BY entity ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)"
)


@query(
    "ffill",
    sql(
        f"SELECT seq, {_FFILL.format(c='signal')} AS signal, {_FFILL.format(c='aux')} AS aux FROM telen", "telen"
    ),
)
def ffill(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele_nulled(spark, folder)
    return forward_fill(t, panel(t), ["signal", "aux"]).select("seq", "signal", "aux")


@query(
    "impute_chain",
    sql(
        """SELECT seq, kind, round(coalesce(signal, ms), 4) AS signal, round(coalesce(aux, ma), 4) AS aux
           FROM f JOIN (SELECT kind, quantile_cont(signal, 0.5) AS ms, quantile_cont(aux, 0.5) AS ma
                        FROM f GROUP BY kind) USING (kind)""",
        "telen",
        f=f"""SELECT seq, kind, {_FFILL.format(c='signal')} AS signal, {_FFILL.format(c='aux')} AS aux FROM telen""",
    ),
)
def impute_chain(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele_nulled(spark, folder)
    out = impute.impute_chain(t, panel(t), ["signal", "aux"], "kind", constants={"flag": 0})
    return out.select("seq", "kind", r("signal"), r("aux"))


@query(
    "quality_report",
    sql(
        """SELECT 'range' AS step, 'signal' AS "column", 'n_bad' AS metric,
                  count(*) FILTER (WHERE signal < -200 OR signal > 100)::DOUBLE AS value FROM tele
           UNION ALL SELECT 'range', 'aux', 'n_bad', count(*) FILTER (WHERE aux < 0 OR aux > 95)::DOUBLE FROM tele
           UNION ALL SELECT 'null', 'signal', 'n_null', count(*) FILTER (WHERE signal IS NULL)::DOUBLE FROM telen
           UNION ALL SELECT 'null', 'aux', 'n_null', count(*) FILTER (WHERE aux IS NULL)::DOUBLE FROM telen
           UNION ALL SELECT 'dedup', 'all', 'rows_after', count(DISTINCT (entity, ts))::DOUBLE FROM tele
           UNION ALL SELECT 'split', split, 'n_rows', count(*)::DOUBLE FROM s GROUP BY split""",
        "telen",
        b="SELECT ts AS edge FROM tele ORDER BY ts LIMIT 1 OFFSET (SELECT floor(count(*) * 0.8::DOUBLE)::BIGINT FROM tele)",
        s="SELECT CASE WHEN ts < edge THEN 'train' ELSE 'test' END AS split FROM tele, b",
    ),
)
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    t, n = views.tele(spark, folder), views.tele_nulled(spark, folder)
    parted = split.split_summary(split.time_split(t, "ts"), "flag", "entity")
    copies = dedup.dedup_report(t, ["entity", "ts"]).withColumn("all", F.lit("all"))
    return quality.quality_report(
        [
            quality.report_rows(quality.range_audit(t, RANGES), "range", "column", ["n_bad"]),
            quality.report_rows(quality.null_audit(n, ["signal", "aux"]), "null", "column", ["n_null"]),
            quality.report_rows(copies, "dedup", "all", ["rows_after"]),
            quality.report_rows(parted, "split", "split", ["n_rows"]),
        ]
    )


DEDUP_ORDER = ["ts", "part", "entity", "quantity", "price"]


@query(
    "dedup_keep_last",
    sql(
        """SELECT l_orderkey, l_linenumber, part, entity, quantity, price FROM (
             SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                    ORDER BY ts DESC, part DESC, entity DESC, quantity DESC, price DESC) AS k FROM li) WHERE k = 1""",
        "li",
    ),
)
def dedup_keep_last(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup.keep_last(views.li(spark, folder), ["l_orderkey", "l_linenumber"], DEDUP_ORDER)
    return kept.select("l_orderkey", "l_linenumber", "part", "entity", "quantity", "price")


@query(
    "dedup_report",
    sql(
        """SELECT (SELECT count(*) FROM li) - (SELECT count(*) FROM d) AS exact_rows,
                  (SELECT count(*) FROM d) - (SELECT count(*) FROM k) AS key_duplicates,
                  (SELECT count(*) FROM k) AS rows_after""",
        "li",
        d="SELECT DISTINCT l_orderkey, l_linenumber, ts, flag FROM li",
        k="SELECT DISTINCT l_orderkey, l_linenumber FROM li",
    ),
)
def dedup_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.li(spark, folder).select("l_orderkey", "l_linenumber", "ts", "flag")
    return dedup.dedup_report(rows, ["l_orderkey", "l_linenumber"])


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    x = tables.table(spark, folder, "lineitem")
    return dedup.distinct_rows(x.select("l_suppkey", "l_returnflag", "l_linestatus"))


@query(
    "union_sources",
    """SELECT CAST(user_id AS VARCHAR) AS source_id, 'event' AS origin, value AS amount FROM events
       UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'order', o_totalprice FROM orders""",
)
def union_sources(spark: SparkSession, folder: str) -> DataFrame:
    e, o = tables.table(spark, folder, "events"), tables.table(spark, folder, "orders")
    return split.union_sources(
        e.select(F.col("user_id").cast("string").alias("source_id"), F.lit("event").alias("origin"), F.col("value").alias("amount")),
        o.select(F.col("o_custkey").cast("string").alias("source_id"), F.lit("order").alias("origin"), F.col("o_totalprice").alias("amount")),
    )


_CAP_VIEWS = {
    "long": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM li WHERE flag = 0" for c in views.LI_SIGNALS
    ),
    "qs": 'SELECT "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM long GROUP BY "column"',
}


@query(
    "iqr_bounds",
    sql(
        """SELECT "column", round(q1, 4) AS q1, round(q3, 4) AS q3, round(q1 - 3 * (q3 - q1), 4) AS lower,
                  round(q3 + 3 * (q3 - q1), 4) AS upper FROM qs""",
        "li",
        **_CAP_VIEWS,
    ),
)
def iqr_bounds(spark: SparkSession, folder: str) -> DataFrame:
    b = outliers.iqr_bounds(views.li(spark, folder), views.LI_SIGNALS, "flag")
    return b.select("column", r("q1"), r("q3"), r("lower"), r("upper"))


@query(
    "iqr_cap",
    sql(
        """SELECT seq, round(CASE WHEN signal < lo THEN lo WHEN signal > hi THEN hi ELSE signal END, 4) AS signal,
                  CASE WHEN signal < lo OR signal > hi THEN 1 ELSE 0 END AS capped FROM tele, b""",
        "tele",
        q="SELECT quantile_cont(signal, 0.25) AS q1, quantile_cont(signal, 0.75) AS q3 FROM tele WHERE flag = 0",
        b="SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q",
    ),
)
def iqr_cap(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder)
    bounds = outliers.iqr_bounds(t, ["signal"], "flag", width=1.5)
    kept = t.withColumn("raw", F.col("signal"))
    out = outliers.iqr_cap(kept, bounds, ["signal"])
    return out.select("seq", r("signal"), F.when(F.col("raw") != F.col("signal"), 1).otherwise(0).alias("capped"))


@query(
    "cap_summary",
    sql(
        """SELECT "column", round(q1 - 1.5 * (q3 - q1), 4) AS lower, round(q3 + 1.5 * (q3 - q1), 4) AS upper,
                  count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS n_capped
           FROM (SELECT 'signal' AS "column", signal AS v FROM tele UNION ALL SELECT 'aux', aux FROM tele)
           JOIN (SELECT 'signal' AS "column", quantile_cont(signal, 0.25) AS q1, quantile_cont(signal, 0.75) AS q3
                 FROM tele WHERE flag = 0
                 UNION ALL SELECT 'aux', quantile_cont(aux, 0.25), quantile_cont(aux, 0.75) FROM tele WHERE flag = 0)
           USING ("column") GROUP BY "column", q1, q3""",
        "tele",
    ),
)
def cap_summary(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder)
    bounds = outliers.iqr_bounds(t, ["signal", "aux"], "flag", width=1.5).select("column", "lower", "upper")
    return outliers.cap_summary(t, bounds, ["signal", "aux"]).select("column", r("lower"), r("upper"), "n_capped")


CODES = {"error": 0, "purchase": 1, "signup": 2}


@query(
    "map_encode",
    sql(
        """SELECT seq, kind, CASE kind WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE -1 END AS code
           FROM tele""",
        "tele",
    ),
)
def map_encode(spark: SparkSession, folder: str) -> DataFrame:
    return views.tele(spark, folder).select("seq", "kind", encode.map_encode("kind", CODES).alias("code"))


@query(
    "label_encode",
    """SELECT 'o_orderpriority' AS "column", v AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
       FROM (SELECT DISTINCT o_orderpriority AS v FROM orders)
       UNION ALL
       SELECT 'o_orderstatus', v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER)
       FROM (SELECT DISTINCT o_orderstatus AS v FROM orders)""",
)
def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    return encode.fit_label_codes(tables.table(spark, folder, "orders"), ["o_orderpriority", "o_orderstatus"])


@query(
    "encode_apply_unseen",
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, CAST(coalesce(code, 0) AS INTEGER) AS code
       FROM orders LEFT JOIN (
         SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
         FROM (SELECT DISTINCT o_orderpriority AS v FROM orders WHERE o_orderpriority <> '3-MEDIUM'))
       ON v = o_orderpriority""",
)
def encode_apply_unseen(spark: SparkSession, folder: str) -> DataFrame:
    o = tables.table(spark, folder, "orders")
    codes = encode.fit_label_codes(o.where("o_orderpriority <> '3-MEDIUM'"), ["o_orderpriority"])
    out = encode.apply_label_codes(o, codes, ["o_orderpriority"])
    return out.select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", F.col("o_orderpriority_code").alias("code")
    )


_CLEAN = {
    "d": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, ts ORDER BY seq DESC) AS k FROM tele)
            WHERE k = 1""",
    "n": "SELECT entity, ts, seq, flag, CASE WHEN signal BETWEEN -200 AND 100 THEN signal END AS signal FROM d",
    "f": f"SELECT entity, ts, seq, flag, {_FFILL.format(c='signal')} AS signal FROM n",
    "q": "SELECT quantile_cont(signal, 0.25) AS q1, quantile_cont(signal, 0.75) AS q3 FROM f WHERE flag = 0",
    "c": """SELECT entity, ts, seq, CASE WHEN signal < q1 - 3 * (q3 - q1) THEN q1 - 3 * (q3 - q1)
                   WHEN signal > q3 + 3 * (q3 - q1) THEN q3 + 3 * (q3 - q1) ELSE signal END AS signal FROM f, q""",
    "b": """SELECT *, CASE WHEN count(signal) OVER w >= 24 THEN avg(signal) OVER w ELSE signal END AS m,
                   CASE WHEN count(signal) OVER w >= 24 THEN stddev_samp(signal) OVER w ELSE 1 END AS s
            FROM c WINDOW w AS (PARTITION BY entity ORDER BY ts, seq ROWS BETWEEN 167 PRECEDING AND CURRENT ROW)""",
}


@query(
    "breach_rate_by_entity",
    sql(
        """SELECT entity, count(*) AS n_readings, CAST(sum(CASE WHEN signal < m - 3 * s THEN 1 ELSE 0 END) AS BIGINT)
                  AS n_breaches, round(avg(CASE WHEN signal < m - 3 * s THEN 1 ELSE 0 END), 6) AS breach_rate
           FROM b GROUP BY entity""",
        "tele",
        **_CLEAN,
    ),
)
def breach_rate_by_entity(spark: SparkSession, folder: str) -> DataFrame:
    """From raw readings to how often the score of each entity breaks its own baseline."""
    raw = views.tele(spark, folder)
    layout = panel(raw)
    clean = dedup.keep_last(raw, ["entity", "ts"], ["seq"])
    clean = quality.null_out_of_range(clean, {"signal": (-200, 100)})
    clean = durable(forward_fill(clean, layout, ["signal"]))
    clean = outliers.iqr_cap(clean, outliers.iqr_bounds(clean, ["signal"], "flag"), ["signal"])
    judged = features.sigma_breach(features.rolling_baseline(clean, layout, "signal"), "signal")
    return judged.groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_readings"),
        F.sum("breach").cast("bigint").alias("n_breaches"),
        r(F.avg("breach"), 6, "breach_rate"),
    )
