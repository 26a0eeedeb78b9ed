"""Queries: samples, splits, scaling, correlations and metrics."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telequal.operators import evaluate, split, stats
from telequal.plans import views
from telequal.plans.registry import query, r, sql
from telequal.sources.tables import table

_EDGE = "SELECT ts AS edge FROM li ORDER BY ts LIMIT 1 OFFSET (SELECT CAST(floor(count(*) * 0.8::DOUBLE) AS BIGINT) FROM li)"


@query(
    "time_split_boundary",
    sql("SELECT (SELECT count(*) FROM li) AS n, edge AS boundary FROM b", "li", b=_EDGE),
)
def time_split_boundary(spark: SparkSession, folder: str) -> DataFrame:
    return split.time_split_boundary(views.li(spark, folder), "ts")


_SPLIT = {"b": _EDGE, "s": "SELECT *, CASE WHEN ts < edge THEN 'train' ELSE 'test' END AS split FROM li, b"}


@query(
    "time_split",
    sql(
        """SELECT split, entity, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts
           FROM s GROUP BY split, entity""",
        "li",
        **_SPLIT,
    ),
)
def time_split(spark: SparkSession, folder: str) -> DataFrame:
    parts = split.time_split(views.li(spark, folder), "ts")
    return parts.groupBy("split", "entity").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query(
    "split_summary",
    sql(
        """SELECT split, count(*) AS n_rows, round(avg(flag), 6) AS label_rate, count(DISTINCT entity) AS n_entities
           FROM s GROUP BY split""",
        "li",
        **_SPLIT,
    ),
)
def split_summary(spark: SparkSession, folder: str) -> DataFrame:
    parts = split.time_split(views.li(spark, folder), "ts")
    return split.split_summary(parts, "flag", "entity").withColumn("label_rate", r("label_rate", 6))


# One-to-one shuffling order of integer keys, spelled in SQL.
_MIX = "(sq * sq % 2147483647) * x % 2147483647"
_ORDERED = {
    "x": "SELECT *, ((event_id % 2147483647) * 48271 + 42) % 2147483647 AS x FROM events",
    "q": "SELECT *, x * x % 2147483647 AS sq FROM x",
    "o": f"""SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS flag, {_MIX} AS ord FROM q""",
    "k": """SELECT *, row_number() OVER (PARTITION BY flag ORDER BY ord) AS k, count(*) OVER (PARTITION BY flag) AS n,
                   row_number() OVER (ORDER BY ord) AS g FROM o""",
}


def _ordered(spark: SparkSession, folder: str) -> DataFrame:
    return views.tele(spark, folder).select(F.col("seq").alias("event_id"), F.col("entity").alias("user_id"), "flag")


@query(
    "stratified_split",
    sql(
        """SELECT event_id, flag, CASE WHEN k <= ROUND(n * 0.2::DOUBLE) THEN 'test'
                  WHEN k <= ROUND(n * 0.2::DOUBLE) + ROUND((n - ROUND(n * 0.2::DOUBLE)) * 0.15::DOUBLE) THEN 'val'
                  ELSE 'train' END AS split FROM k""",
        **_ORDERED,
    ),
)
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    out = split.stratified_split(_ordered(spark, folder), "flag", split.mix(F.col("event_id")))
    return out.select("event_id", "flag", "split")


@query(
    "stratified_sample",
    sql("SELECT event_id, flag FROM k WHERE k <= CASE WHEN flag = 0 THEN 2000 ELSE 400 END", **_ORDERED),
)
def stratified_sample(spark: SparkSession, folder: str) -> DataFrame:
    out = split.stratified_sample(_ordered(spark, folder), "flag", split.mix(F.col("event_id")), 2000)
    return out.select("event_id", "flag")


@query("uniform_sample", sql("SELECT event_id, flag FROM k WHERE g <= 5000", **_ORDERED))
def uniform_sample(spark: SparkSession, folder: str) -> DataFrame:
    return split.uniform_sample(_ordered(spark, folder), split.mix(F.col("event_id")), 5000).select("event_id", "flag")


@query(
    "class_balance",
    sql(
        """SELECT count(*) AS n, CAST(sum(flag) AS BIGINT) AS n_pos, count(*) - CAST(sum(flag) AS BIGINT) AS n_neg,
                  round(sum(flag) / count(*), 4) AS pos_rate, round((count(*) - sum(flag)) / sum(flag), 4) AS pos_weight
           FROM tele""",
        "tele",
    ),
)
def class_balance(spark: SparkSession, folder: str) -> DataFrame:
    return split.class_balance(views.tele(spark, folder), "flag")


@query(
    "oversample",
    sql(
        """SELECT seq, flag, CAST(unnest(generate_series(1, CASE WHEN flag = 1 THEN greatest(1, w) ELSE 1 END)) AS INTEGER)
                  AS copy_no
           FROM tele, (SELECT CAST(round_even((count(*) - sum(flag)) / sum(flag), 0) AS INTEGER) AS w FROM tele)""",
        "tele",
    ),
)
def oversample(spark: SparkSession, folder: str) -> DataFrame:
    return split.oversample(views.tele(spark, folder), "flag").select("seq", "flag", "copy_no")


@query(
    "standardize",
    sql(
        """SELECT seq, split, round((signal - sm) / CASE WHEN sd > 0 THEN sd ELSE 1 END, 4) AS signal,
                  round((aux - am) / CASE WHEN ad > 0 THEN ad ELSE 1 END, 4) AS aux
           FROM s, (SELECT avg(signal) AS sm, stddev_pop(signal) AS sd, avg(aux) AS am, stddev_pop(aux) AS ad
                    FROM s WHERE split = 'train')""",
        "tele",
        b=_EDGE.replace("FROM li", "FROM tele"),
        s="SELECT *, CASE WHEN ts < edge THEN 'train' ELSE 'test' END AS split FROM tele, b",
    ),
)
def standardize(spark: SparkSession, folder: str) -> DataFrame:
    parts = split.time_split(views.tele(spark, folder), "ts")
    fitted = stats.fit_standardizer(parts.where("split = 'train'"), ["signal", "aux"])
    return stats.standardize(parts, fitted, ["signal", "aux"]).select("seq", "split", r("signal"), r("aux"))


@query(
    "minmax_norm",
    sql(
        """SELECT seq, round((signal - sl) / (sh - sl + 1e-9), 6) AS signal_norm,
                  round((aux - al) / (ah - al + 1e-9), 6) AS aux_norm
           FROM tele, (SELECT min(signal) AS sl, max(signal) AS sh, min(aux) AS al, max(aux) AS ah
                       FROM tele WHERE flag = 0)""",
        "tele",
    ),
)
def minmax_norm(spark: SparkSession, folder: str) -> DataFrame:
    t = views.tele(spark, folder)
    fitted = stats.fit_minmax(t.where("flag = 0"), ["signal", "aux"])
    out = stats.minmax_norm(t, fitted, ["signal", "aux"])
    return out.select("seq", r("signal_norm", 6), r("aux_norm", 6))


@query(
    "corr_target",
    sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", round(corr({c}, flag), 6) AS r FROM li" for c in views.LI_SIGNALS
        ),
        "li",
    ),
)
def corr_target(spark: SparkSession, folder: str) -> DataFrame:
    return stats.corr_target(views.li(spark, folder), views.LI_SIGNALS, "flag").select("column", r("r", 6))


_NUMBERS = [
    "tenure_months",
    "monthly_charges",
    "charge_per_tenure_ratio",
    "anomaly_count_30d",
    "anomaly_severity_score",
    "wifi_breach_count_30d",
    "days_since_last_anomaly",
]


@query(
    "corr_pairs",
    sql(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(abs(corr({a}, {b})), 6) AS r FROM customers"
            for a, b in combinations(_NUMBERS, 2)
        )
        + ") WHERE r > 0.85",
        "customers",
    ),
)
def corr_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return stats.corr_pairs(views.customers(spark, folder), _NUMBERS).select("left", "right", r("r", 6))


@query(
    "series_profile",
    sql(
        """SELECT entity, count(signal) AS n, round(avg(signal), 4) AS mean, round(stddev_samp(signal), 4) AS std
           FROM tele GROUP BY entity""",
        "tele",
    ),
)
def series_profile(spark: SparkSession, folder: str) -> DataFrame:
    return stats.series_profile(views.tele(spark, folder), "entity", "signal").select("entity", "n", r("mean"), r("std"))


@query(
    "label_histogram",
    sql(
        """SELECT flag AS label, CAST(least(floor((price - lo) / (hi - lo) * 60), 59) AS INTEGER) AS bin, count(*) AS n
           FROM li, (SELECT min(price) AS lo, max(price) AS hi FROM li) GROUP BY 1, 2""",
        "li",
    ),
)
def label_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return stats.label_histogram(views.li(spark, folder), "price", "flag")


_F = """CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0 END"""


def _confusion(source: str, label: str, pred: str, key: str = "") -> str:
    k = f"{key}, " if key else ""
    by = f"GROUP BY {key}" if key else ""
    return f"""SELECT {k}tn, fp, fn, tp, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
                 round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall, round({_F}, 6) AS f1
               FROM (SELECT {k}count(*) FILTER (WHERE NOT ({pred}) AND {label} = 0) AS tn,
                            count(*) FILTER (WHERE ({pred}) AND {label} = 0) AS fp,
                            count(*) FILTER (WHERE NOT ({pred}) AND {label} = 1) AS fn,
                            count(*) FILTER (WHERE ({pred}) AND {label} = 1) AS tp FROM {source} {by})"""


@query("confusion_metrics", sql(_confusion("li", "flag", "quantity > 30"), "li"))
def confusion_metrics(spark: SparkSession, folder: str) -> DataFrame:
    m = evaluate.confusion_metrics(views.li(spark, folder), "flag", F.col("quantity") > 30)
    return m.select("tn", "fp", "fn", "tp", *[r(c, 6) for c in ("precision", "recall", "f1")])


def _auc(source: str, score: str, label: str) -> str:
    """Rank-sum form over distinct scores."""
    return f"""SELECT CAST(max(tp) AS BIGINT) AS n_pos, CAST(max(tn) AS BIGINT) AS n_neg,
                 round(sum(pos * (below + neg / 2)) / (max(tp)::DOUBLE * max(tn)), 6) AS auc
               FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY s) - neg AS below, sum(pos) OVER () AS tp,
                            sum(neg) OVER () AS tn
                     FROM (SELECT {score} AS s, count(*) FILTER (WHERE {label} = 1) AS pos,
                                  count(*) FILTER (WHERE {label} = 0) AS neg FROM {source} GROUP BY 1))"""


@query("roc_auc", sql(_auc("li", "price", "flag"), "li"))
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.roc_auc(views.li(spark, folder), "flag", "price").withColumn("auc", r("auc", 6))


_DOCS = "documents JOIN labels USING (doc_id)"


@query("document_quality_auc", _auc(_DOCS, "n_chars", "quality"))
def document_quality_auc(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents").select("doc_id", "n_chars")
    x = d.join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")
    return evaluate.roc_auc(x, "quality", "n_chars").withColumn("auc", r("auc", 6))


_CURVE = """SELECT s AS threshold, tp, fp, pos, n, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p, tp / n AS rc
            FROM (SELECT s, pos, CAST(sum(pos) OVER (ORDER BY s DESC) AS BIGINT) AS tp,
                         CAST(sum(neg) OVER (ORDER BY s DESC) AS BIGINT) AS fp, sum(pos) OVER () AS n
                  FROM (SELECT price AS s, count(*) FILTER (WHERE flag = 1) AS pos,
                               count(*) FILTER (WHERE flag = 0) AS neg FROM li GROUP BY 1))"""


@query(
    "pr_curve",
    sql(
        """SELECT threshold, tp, fp, round(p, 6) AS precision, round(rc, 6) AS recall,
                  round(2.0::DOUBLE * p * rc / (p + rc + 1e-9), 6) AS f1 FROM c""",
        "li",
        c=_CURVE,
    ),
)
def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    c = evaluate.pr_curve(views.li(spark, folder), "flag", "price")
    return c.select("threshold", "tp", "fp", *[r(x, 6) for x in ("precision", "recall", "f1")])


@query(
    "best_f1_threshold",
    sql(
        """SELECT threshold, round(p, 6) AS precision, round(rc, 6) AS recall, round(f, 6) AS f1
           FROM (SELECT *, 2.0::DOUBLE * p * rc / (p + rc + 1e-9) AS f FROM c) ORDER BY f DESC, threshold LIMIT 1""",
        "li",
        c=_CURVE,
    ),
)
def best_f1_threshold(spark: SparkSession, folder: str) -> DataFrame:
    c = evaluate.pr_curve(views.li(spark, folder), "flag", "price")
    return evaluate.best_f1_threshold(c).select("threshold", *[r(x, 6) for x in ("precision", "recall", "f1")])


@query(
    "average_precision",
    sql("SELECT round(sum(pos / n * p), 6) AS average_precision FROM c", "li", c=_CURVE),
)
def average_precision(spark: SparkSession, folder: str) -> DataFrame:
    c = evaluate.pr_curve(views.li(spark, folder), "flag", "price")
    return evaluate.average_precision(c).select(r("average_precision", 6))


_DRIFT = ["quantity", "price", "discount", "tax"]


@query(
    "ks_drift",
    sql(
        """SELECT "column", CAST(max(ta) AS BIGINT) AS n_first, CAST(max(tb) AS BIGINT) AS n_second,
                  round(max(abs(ca / ta - cb / tb)), 6) AS ks
           FROM (SELECT "column", sum(a) OVER w AS ca, sum(b) OVER w AS cb,
                        sum(a) OVER (PARTITION BY "column") AS ta, sum(b) OVER (PARTITION BY "column") AS tb
                 FROM v WINDOW w AS (PARTITION BY "column" ORDER BY x)) GROUP BY "column" """,
        "li",
        **_SPLIT,
        v="SELECT \"column\", x, count(*) FILTER (WHERE split = 'train') AS a, count(*) FILTER (WHERE split = 'test') AS b FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS x, split FROM s" for c in _DRIFT)
        + ") GROUP BY 1, 2",
    ),
)
def ks_drift(spark: SparkSession, folder: str) -> DataFrame:
    parts = split.time_split(views.li(spark, folder), "ts")
    return evaluate.ks_drift(parts, _DRIFT, F.col("split") == "test").withColumn("ks", r("ks", 6))
