"""Queries: neighbours, outlier scores, ensemble, importance, churn scoring and attribution."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telequal.functions import rules
from telequal.operators import anomaly, churn, evaluate, neighbours, split, stats
from telequal.plans import views
from telequal.plans.registry import query, r, sql
from telequal.schemas import IF_SAMPLE, IF_TREES, LOF_NEIGHBOURS
from telequal.session import durable
from telequal.sources.tables import table

K = LOF_NEIGHBOURS


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))


_KNN = {
    "v": "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings",
    "d": "SELECT a.id, b.id AS neighbour, list_distance(a.vec, b.vec) AS dist FROM v a JOIN v b ON a.id <> b.id",
    "nn": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, neighbour) AS k FROM d)
              WHERE k <= {K}""",
}


@query(
    "knn_join",
    sql("SELECT id, CAST(k AS INTEGER) AS rank, neighbour, round(dist, 4) AS dist FROM nn", **_KNN),
)
def knn_join(spark: SparkSession, folder: str) -> DataFrame:
    v = _vectors(spark, folder)
    return neighbours.knn_join(v, v, K, skip_self=True).select("id", "rank", "neighbour", r("dist"))


@query(
    "lof_score",
    sql(
        """SELECT nn.id, round(avg(o.lrd) / any_value(m.lrd), 6) AS lof FROM nn JOIN lrd o ON o.id = nn.neighbour
           JOIN lrd m ON m.id = nn.id GROUP BY nn.id""",
        **_KNN,
        kd="SELECT id, max(dist) AS kdist FROM nn GROUP BY id",
        lrd="""SELECT nn.id, 1 / (avg(greatest(dist, kdist)) + 1e-10) AS lrd FROM nn JOIN kd ON kd.id = nn.neighbour
               GROUP BY nn.id""",
    ),
)
def lof_score(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.fit_lof(_vectors(spark, folder), K).select("id", r("lof", 6))


@query(
    "lof_novelty",
    sql(
        """SELECT q.id, round(avg(lrd) * (avg(greatest(dist, kdist)) + 1e-10), 6) AS lof
           FROM (SELECT * FROM (SELECT a.id, b.id AS neighbour, list_distance(a.vec, b.vec) AS dist,
                        row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.vec, b.vec), b.id) AS k
                 FROM v a JOIN v b ON a.label >= 7 AND b.label < 7) WHERE k <= 20) q
           JOIN lrd ON lrd.id = q.neighbour JOIN kd ON kd.id = q.neighbour GROUP BY q.id""",
        v="SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings",
        nn=f"""SELECT * FROM (SELECT a.id, b.id AS neighbour, list_distance(a.vec, b.vec) AS dist,
                   row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.vec, b.vec), b.id) AS k
               FROM v a JOIN v b ON a.id <> b.id AND a.label < 7 AND b.label < 7) WHERE k <= {K}""",
        kd="SELECT id, max(dist) AS kdist FROM nn GROUP BY id",
        lrd="""SELECT nn.id, 1 / (avg(greatest(dist, kdist)) + 1e-10) AS lrd FROM nn JOIN kd ON kd.id = nn.neighbour
               GROUP BY nn.id""",
    ),
)
def lof_novelty(spark: SparkSession, folder: str) -> DataFrame:
    """New classes scored against the classes the model was fitted on."""
    known = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label"
    )
    model = neighbours.fit_lof(known.where("label < 7"), K)
    return neighbours.lof_score(known.where("label >= 7"), model, K).select("id", r("lof", 6))


# Fixed value: length of the vectors in the embeddings table.
EMBEDDING_SIZE = 64
LI_FEATURES = views.LI_SIGNALS
LI_KEYS = ["row_id"]


def _mix(key: str, seed: int | str) -> str:
    """The one-to-one shuffling order of whole numbers, spelled in SQL."""
    x = f"((({key}) % 2147483647) * 48271 + {seed}) % 2147483647"
    square = f"(({x}) * ({x}) % 2147483647)"
    return f"(({square} * {square} % 2147483647) * ({x}) % 2147483647)"


def _forest_sql(source: str, key: str, features: list[str], trees: int = IF_TREES, sample: int = IF_SAMPLE, seed: int = 42):
    """The isolation forest of ``source`` in SQL, level by level: ends in ``nodes`` (tree, node, feature, cut, path)."""
    width, levels = len(features), math.ceil(math.log2(sample))
    at = f"(tree * {anomaly.TREE_STEP} + node)"
    parts = {
        "fk": f"SELECT {key} AS k, [{', '.join(f'CAST(coalesce({f}, 0) AS DOUBLE)' for f in features)}] AS x FROM {source}",
        "fn": f"""SELECT n, CAST(greatest(1, least({trees}, floor(n / {1.5 * sample}::DOUBLE))) AS BIGINT) AS deal
                  FROM (SELECT count(*) AS n FROM fk)""",
        "fd": f"""
            SELECT k, x, t * deal + {_mix('k', f't + {seed + anomaly.DEAL}')} % deal AS tree
            FROM (SELECT *, unnest(range(CAST(ceil({trees} / deal) AS BIGINT))) AS t FROM fk, fn
                  WHERE {_mix('k', seed + anomaly.DRAW)} < least(1, {1.5 * sample}::DOUBLE * deal / n) * 2147483647)""",
        "f0": f"""
            SELECT tree, 1 AS node, x, ceil(log2(greatest(count(*) OVER (PARTITION BY tree), 2))) AS most FROM (
                SELECT * FROM fd WHERE tree < {trees} QUALIFY row_number() OVER (
                    PARTITION BY tree ORDER BY {_mix('k', f'tree + {seed + anomaly.RANK}')}, k, x) <= {sample})""",
    }
    for level in range(levels + 1):
        lows, highs = (", ".join(f"{f}(x[{i}])" for i in range(1, width + 1)) for f in ("min", "max"))
        parts[f"s{level}"] = f"""
            SELECT tree, node, n, most, lo, hi, list_filter(range(1, {width + 1}), lambda i: hi[i] > lo[i]) AS live FROM (
                SELECT tree, node, count(*) AS n, any_value(most) AS most, [{lows}] AS lo, [{highs}] AS hi
                FROM f{level} GROUP BY tree, node)"""
        parts[f"c{level}"] = f"""
            SELECT *, lo[feature] + (hi[feature] - lo[feature]) * ({_mix(at, seed + anomaly.CUT)} / 2147483647::DOUBLE) AS cut
            FROM (SELECT *, CASE WHEN {level} < most AND n > 1 AND len(live) > 0
                                 THEN live[1 + {_mix(at, seed + anomaly.PICK)} % len(live)] END AS feature FROM s{level})"""
        parts[f"f{level + 1}"] = f"""
            SELECT tree, 2 * node + CASE WHEN x[feature] <= cut THEN 0 ELSE 1 END AS node, x, f.most
            FROM f{level} f JOIN c{level} USING (tree, node) WHERE feature IS NOT NULL"""
    constant = f"CASE WHEN n <= 1 THEN 0 WHEN n = 2 THEN 1 ELSE 2 * (ln(n - 1) + {anomaly.EULER_GAMMA!r}::DOUBLE) - 2 * (n - 1) / n END"
    parts["nodes"] = " UNION ALL ".join(
        f"SELECT tree, node, feature, cut, CASE WHEN feature IS NULL THEN {level} + {constant} END AS path FROM c{level}"
        for level in range(levels + 1)
    )
    return parts


def _walk_sql(rows: str, sample: int = IF_SAMPLE) -> dict[str, str]:
    """(k, if_score) of ``rows`` (k, x): every row walks down every tree."""
    levels = math.ceil(math.log2(sample))
    step = "SELECT k, x, w.tree, CASE WHEN feature IS NULL THEN w.node WHEN x[feature] <= cut THEN 2 * w.node ELSE 2 * w.node + 1 END AS node FROM"
    walked = f"(SELECT k, x, tree, 1 AS node FROM {rows}, (SELECT DISTINCT tree FROM nodes))"
    for _ in range(levels):
        walked = f"({step} {walked} w JOIN nodes n ON n.tree = w.tree AND n.node = w.node)"
    c = float(anomaly.path_constant(sample))
    return {
        "walked": f"""SELECT k, pow(2, -avg(path) / {c!r}::DOUBLE) AS if_score
                      FROM {walked} w JOIN nodes n ON n.tree = w.tree AND n.node = w.node GROUP BY k"""
    }


def _kept_sql(body: str, *needed: str, **parts: str) -> str:
    """As :func:`sql`, with every part computed once."""
    text = sql(body, *needed, **parts)
    for name in parts:
        text = text.replace(f", {name} AS (", f", {name} AS MATERIALIZED (").replace(f"WITH {name} AS (", f"WITH {name} AS MATERIALIZED (")
    return text


_LI_SQL = {
    "lk": """SELECT l_orderkey * 100 + l_linenumber AS row_id, * FROM (
                 SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                        ORDER BY ts DESC, part DESC, entity DESC, quantity DESC, price DESC) AS k FROM li) WHERE k = 1""",
    "b": "SELECT ts AS edge FROM lk ORDER BY ts LIMIT 1 OFFSET (SELECT CAST(floor(count(*) * 0.8::DOUBLE) AS BIGINT) FROM lk)",
    "ls": "SELECT *, CASE WHEN ts < edge THEN 'train' ELSE 'test' END AS split FROM lk, b",
    "st": "SELECT "
    + ", ".join(
        f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END AS s_{c}" for c in views.LI_SIGNALS
    )
    + " FROM ls WHERE split = 'train'",
    "lz": f"SELECT row_id, split, flag, {', '.join(f'({c} - m_{c}) / s_{c} AS {c}' for c in views.LI_SIGNALS)} FROM ls, st",
    "lt": "SELECT * FROM lz WHERE split = 'train'",
    **_forest_sql("lt", "row_id", views.LI_SIGNALS),
}


def _li_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with one row per key, as readings of a panel."""
    from telequal.operators.dedup import keep_last
    from telequal.plans.q_quality import DEDUP_ORDER

    rows = keep_last(views.li(spark, folder), ["l_orderkey", "l_linenumber"], DEDUP_ORDER)
    rows = rows.withColumn("row_id", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    return durable(rows.select("row_id", "ts", "flag", *LI_FEATURES))


def _scored_li(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(training-time model, rows with split and isolation score)."""
    parts = split.time_split(_li_rows(spark, folder), "ts")
    fitted = stats.fit_standardizer(parts.where("split = 'train'"), LI_FEATURES)
    scaled = stats.standardize(parts, fitted, LI_FEATURES)
    model = anomaly.fit_isolation_forest(scaled.where("split = 'train'"), LI_FEATURES, LI_KEYS)
    return model, scaled


@query(
    "iforest_score",
    _kept_sql(
        "SELECT row_id, split, round(if_score, 6) AS if_score FROM walked JOIN lz ON k = row_id",
        "li",
        **_LI_SQL,
        lx=f"SELECT row_id AS k, [{', '.join(views.LI_SIGNALS)}] AS x FROM lz",
        **_walk_sql("lx"),
    ),
)
def iforest_score(spark: SparkSession, folder: str) -> DataFrame:
    model, scaled = _scored_li(spark, folder)
    return anomaly.isolation_score(scaled, model, LI_FEATURES).select("row_id", "split", r("if_score", 6))


def _ensemble(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings scored by both detectors; the limits come from the known classes."""
    e = table(spark, folder, "embeddings")
    dims = [f"d{i}" for i in range(EMBEDDING_SIZE)]
    rows = e.select(
        F.col("vec_id").alias("id"),
        "label",
        F.col("embedding").cast("array<double>").alias("vec"),
        *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(dims)],
    )
    known = rows.where("label < 7")
    forest = anomaly.fit_isolation_forest(known, dims, ["id"])
    density = neighbours.fit_lof(known.select("id", "vec"), K)
    scores = neighbours.lof_score(rows.select("id", "vec"), density, K)
    both = anomaly.isolation_score(rows, forest, dims).join(scores, "id")
    both = durable(both.select("id", "label", "if_score", "lof"))
    return anomaly.ensemble_score(both, anomaly.fit_ensemble(both.where("label < 7")))


@query(
    "ensemble_score",
    _kept_sql(
        """SELECT id, round(e, 6) AS ensemble, CASE WHEN e > 0.65::DOUBLE THEN 'High' WHEN e > 0.5::DOUBLE THEN 'Medium' ELSE 'Normal' END
                  AS severity, e > 0.5::DOUBLE AS is_anomaly FROM blended""",
        v="SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings",
        known="SELECT * FROM v WHERE label < 7",
        **_forest_sql("known", "id", [f"vec[{i}]" for i in range(1, EMBEDDING_SIZE + 1)]),
        vx="SELECT id AS k, vec AS x FROM v",
        **_walk_sql("vx"),
        pairs="""SELECT a.id, a.label, b.id AS neighbour, list_distance(a.vec, b.vec) AS dist FROM v a JOIN known b ON true""",
        nn=f"""SELECT * FROM pairs WHERE label < 7 AND id <> neighbour
               QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist, neighbour) <= {K}""",
        kd="SELECT id, max(dist) AS kdist FROM nn GROUP BY id",
        lrd="""SELECT nn.id, 1 / (avg(greatest(dist, kdist)) + 1e-10) AS lrd FROM nn JOIN kd ON kd.id = nn.neighbour
               GROUP BY nn.id""",
        near=f"SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist, neighbour) <= {K}",
        lof="""SELECT near.id, avg(lrd) * (avg(greatest(dist, kdist)) + 1e-10) AS lof
               FROM near JOIN lrd ON lrd.id = near.neighbour JOIN kd ON kd.id = near.neighbour GROUP BY near.id""",
        scored="SELECT v.id, v.label, if_score, lof FROM v JOIN walked ON k = v.id JOIN lof ON lof.id = v.id",
        lim="""SELECT min(if_score) AS il, max(if_score) AS ih, min(lof) AS ll, max(lof) AS lh FROM scored WHERE label < 7""",
        blended="""SELECT id, (if_score - il) / (ih - il + 1e-9) * 0.6::DOUBLE + (lof - ll) / (lh - ll + 1e-9) * 0.4::DOUBLE AS e
                   FROM scored, lim""",
    ),
)
def ensemble_score(spark: SparkSession, folder: str) -> DataFrame:
    scored = _ensemble(spark, folder)
    cut = F.lit(0.5)
    return scored.select(
        "id", r("ensemble", 6), rules.severity_band(F.col("ensemble"), cut).alias("severity"),
        anomaly.decide(F.col("ensemble"), cut).alias("is_anomaly"),
    )


_SHUFFLED = " UNION ALL ".join(
    f"SELECT {i} AS shuffled, row_id, flag, [{', '.join(f'd_{c}' if c == f else c for c in LI_FEATURES)}] AS x FROM shifted"
    for i, f in enumerate(["", *LI_FEATURES])
)


@query(
    "permutation_importance",
    _kept_sql(
        f"""SELECT feature, round(auc, 6) AS auc, round((SELECT auc FROM aucs WHERE shuffled = 0) - auc, 6) AS "drop"
            FROM aucs JOIN (SELECT unnest([{', '.join(f"'{f}'" for f in LI_FEATURES)}]) AS feature,
                                   unnest(range(1, {len(LI_FEATURES) + 1})) AS shuffled) USING (shuffled)""",
        "li",
        **_LI_SQL,
        tests=f"""SELECT *, {_mix('row_id', 42 + anomaly.PERMUTE)} AS h FROM lz WHERE split = 'test'""",
        shifted="SELECT row_id, flag, "
        + ", ".join(
            f"{c}, coalesce(lead({c}) OVER (ORDER BY h, row_id), first({c}) OVER (ORDER BY h, row_id)) AS d_{c}" for c in LI_FEATURES
        )
        + " FROM tests",
        px=f"SELECT row_id * 10 + shuffled AS k, x FROM ({_SHUFFLED})",
        **_walk_sql("px"),
        judged="SELECT k % 10 AS shuffled, flag, if_score AS s FROM walked JOIN tests ON row_id = k // 10",
        counts="""SELECT shuffled, s, count(*) FILTER (WHERE flag = 1) AS pos, count(*) FILTER (WHERE flag = 0) AS neg
                  FROM judged GROUP BY shuffled, s""",
        aucs="""SELECT shuffled, sum(pos * (below - neg / 2)) / (sum(pos) * sum(neg)) AS auc
                FROM (SELECT *, sum(neg) OVER (PARTITION BY shuffled ORDER BY s) AS below FROM counts) GROUP BY shuffled""",
    ),
)
def permutation_importance(spark: SparkSession, folder: str) -> DataFrame:
    model, scaled = _scored_li(spark, folder)
    test = scaled.where("split = 'test'").select("row_id", "flag", *LI_FEATURES)
    found = anomaly.permutation_importance(
        test, LI_FEATURES, LI_KEYS, "flag", lambda d: anomaly.isolation_score(d, model, LI_FEATURES), "if_score"
    )
    return found.select("feature", r("auc", 6), r("drop", 6))


def _customer_parts(spark: SparkSession, folder: str) -> DataFrame:
    crm = views.crm(spark, folder)
    return split.stratified_split(crm, "churn", split.mix(F.col("customer_id")))


@query("churn_score")
def churn_score(spark: SparkSession, folder: str) -> DataFrame:
    """Train on the training part, tune on validation, score every customer."""
    parts = durable(_customer_parts(spark, folder))
    model = churn.fit_churn(parts.where("split = 'train'"), "network")
    threshold = churn.tune_threshold(churn.churn_probability(parts.where("split = 'val'"), model))
    out = churn.score_customers(parts.select("customer_id", "split", *churn.CUSTOMER_DEFAULTS), model, threshold)
    return out.select(
        "customer_id",
        "split",
        "churn_probability",
        "churn_prediction",
        "risk_level",
        F.array_join("top_reasons", " | ").alias("reasons"),
        "retention_action",
    )


@query("churn_history")
def churn_history(spark: SparkSession, folder: str) -> DataFrame:
    """Loss and validation AUC of every epoch of the churn network."""
    train = durable(_customer_parts(spark, folder).where("split = 'train'"))
    history = churn.training_history(churn.fit_churn(train, "network"))
    return history.select("epoch", r("loss", 6), r("val_score", 6))


@query("churn_evaluation")
def churn_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    """Test metrics of the weighted linear baseline."""
    parts = durable(_customer_parts(spark, folder))
    model = churn.fit_churn(parts.where("split = 'train'"), "logistic")
    threshold = churn.tune_threshold(churn.churn_probability(parts.where("split = 'val'"), model))
    test = churn.churn_probability(parts.where("split = 'test'"), model)
    return churn.evaluate_churn(test, threshold).select("metric", r("value", 6))


ATTRIBUTED = [
    "tenure_months",
    "monthly_charges",
    "charge_per_tenure_ratio",
    "service_call_frequency_30d",
    "anomaly_count_30d",
    "wifi_breach_count_30d",
    "days_since_last_anomaly",
]
_ATTR = {
    "w": "SELECT "
    + ", ".join(
        f"corr({c}, churn) AS w_{c}, avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END AS s_{c}"
        for c in ATTRIBUTED
    )
    + " FROM crm",
    "a": " UNION ALL ".join(
        f"SELECT customer_id, '{c}' AS feature, ({c} - m_{c}) / s_{c} * w_{c} AS v FROM crm, w" for c in ATTRIBUTED
    ),
    "g": "SELECT feature, avg(abs(v)) AS mean_abs FROM a GROUP BY feature",
}


def _attributed(spark: SparkSession, folder: str) -> DataFrame:
    """Linear scorecard: standardised features weighted by their correlation with the label."""
    crm = durable(views.crm(spark, folder).select("customer_id", "churn", *ATTRIBUTED))
    weights = crm.agg(*[F.corr(c, "churn").alias(c) for c in ATTRIBUTED])
    fitted = stats.fit_standardizer(crm, ATTRIBUTED)
    return churn.linear_attribution(crm, weights, fitted, ATTRIBUTED, "customer_id")


@query("attribution_local", sql("SELECT customer_id, feature, round(v, 6) AS attribution FROM a", "crm", **_ATTR))
def attribution_local(spark: SparkSession, folder: str) -> DataFrame:
    return _attributed(spark, folder).select("customer_id", "feature", r("attribution", 6))


@query("attribution_global", sql("SELECT feature, round(mean_abs, 6) AS mean_abs FROM g", "crm", **_ATTR))
def attribution_global(spark: SparkSession, folder: str) -> DataFrame:
    return churn.attribution_global(_attributed(spark, folder)).select("feature", r("mean_abs", 6))


@query(
    "topk_features",
    sql(
        "SELECT feature, round(mean_abs, 6) AS mean_abs FROM g ORDER BY g.mean_abs DESC, feature LIMIT 5", "crm", **_ATTR
    ),
)
def topk_features(spark: SparkSession, folder: str) -> DataFrame:
    found = churn.attribution_global(_attributed(spark, folder))
    return stats.topk(found, "mean_abs", 5, "feature").select("feature", r("mean_abs", 6))


@query(
    "importance_share",
    sql("SELECT feature, round(mean_abs / (SELECT max(mean_abs) FROM g) * 100, 4) AS pct_of_max FROM g", "crm", **_ATTR),
)
def importance_share(spark: SparkSession, folder: str) -> DataFrame:
    found = durable(churn.attribution_global(_attributed(spark, folder)))
    return stats.importance_share(found, "mean_abs").select("feature", r("pct_of_max"))


@query("attribution_sampled")
def attribution_sampled(spark: SparkSession, folder: str) -> DataFrame:
    """Sampled attribution of the rule score, a scorer with caps and steps."""
    c = durable(views.customers(spark, folder))
    features = ["contract_type", "tenure_months", "monthly_charges", "anomaly_count_30d", "wifi_breach_count_30d"]
    local = churn.sampled_attribution(
        c, c, features, "customer_id", lambda d: d.withColumn("s", rules.fallback_risk_score()), "s"
    )
    return local.select("customer_id", "feature", r("attribution", 6))
