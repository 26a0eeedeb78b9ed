"""Churn model: preparation, training, scoring with reasons, and attribution."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telequal.functions import rules
from telequal.functions.numbers import steady_round
from telequal.operators import network
from telequal.operators.encode import apply_label_codes, fit_label_codes
from telequal.operators.evaluate import (
    average_precision,
    best_f1_threshold,
    confusion_metrics,
    pr_curve,
    roc_auc,
)
from telequal.operators.ordered import fitted_row, number
from telequal.operators.split import hashed, oversample, uniform_sample
from telequal.operators.stats import fit_standardizer, standardize
from telequal.schemas import (
    CHURN_FEATURES,
    CUSTOMER_CATEGORIES,
    CUSTOMER_DEFAULTS,
    CUSTOMER_NUMBERS,
    CUSTOMER_SCHEMA,
    HIDDEN_LAYERS,
)
from telequal.session import durable

LABEL = "churn"
# Training rows below which another task costs more than it saves.
ROWS_PER_TASK = 10_000


@dataclass(frozen=True)
class ChurnModel:
    codes: DataFrame
    scaler: DataFrame
    classifier: Model | network.Network


def _model_inputs(df: DataFrame, codes: DataFrame, scaler: DataFrame) -> DataFrame:
    """Encode, scale the 13 columns and assemble the 12 features under ``features``.

    Inputs take the prefix ``x_``, so the customer's own columns stay as they were.
    """
    coded = apply_label_codes(df, codes, CUSTOMER_CATEGORIES)
    raw = coded.withColumns(
        {f"x_{c}": F.col(f"{c}_code").cast("double") for c in CUSTOMER_CATEGORIES}
        | {f"x_{c}": F.col(c).cast("double") for c in CUSTOMER_NUMBERS}
    )
    names = [f"x_{c}" for c in CUSTOMER_CATEGORIES + CUSTOMER_NUMBERS]
    scaled = standardize(raw, scaler, names)
    ready = VectorAssembler(
        inputCols=[f"x_{c}" for c in CHURN_FEATURES], outputCol="features", handleInvalid="keep"
    ).transform(scaled)
    return ready.drop(*[f"{c}_code" for c in CUSTOMER_CATEGORIES])


def fit_churn(
    train: DataFrame, kind: str = "mlp", max_iter: int = 100, seed: int = 42, keys: Sequence[str] = ("customer_id",)
) -> ChurnModel:
    """Fit codes and scaling on the training rows, then a model of one ``kind``.

    'network' trains by epochs with an early stop on rows held out by ``keys`` (see :mod:`telequal.operators.network`), 'mlp'
    is Spark ML's perceptron over all rows, 'logistic' the linear baseline.
    """
    codes = fit_label_codes(train, CUSTOMER_CATEGORIES)
    coded = apply_label_codes(train, codes, CUSTOMER_CATEGORIES)
    numbers = coded.select(
        *[F.col(f"{c}_code").cast("double").alias(f"x_{c}") for c in CUSTOMER_CATEGORIES],
        *[F.col(c).cast("double").alias(f"x_{c}") for c in CUSTOMER_NUMBERS],
    )
    scaler = fit_standardizer(numbers, numbers.columns)
    # Small fitted tables become local rows, so that scoring never repeats the fit.
    spark = train.sparkSession
    codes = spark.createDataFrame(codes.collect(), codes.schema)
    scaler = spark.createDataFrame(scaler.collect(), scaler.schema)
    ready = _model_inputs(train, codes, scaler)
    if kind == "network":
        fitted = network.fit_network(ready, vector_to_array("features"), LABEL, keys, HIDDEN_LAYERS, max_iter, seed=seed)
        return ChurnModel(codes, scaler, fitted)
    rows = ready.select("features", F.col(LABEL).cast("double").alias("label"))
    if kind == "mlp":
        rows = oversample(rows, "label").select("features", "label")
        learner = MultilayerPerceptronClassifier(
            layers=[len(CHURN_FEATURES), *HIDDEN_LAYERS, 2], maxIter=max_iter, seed=seed
        )
    else:
        n_pos = F.greatest(F.count_if(F.col("label") == 1), F.lit(1))
        weight = rows.agg(F.count_if(F.col("label") != 1) / n_pos).first()[0]
        rows = rows.withColumn("weight", F.when(F.col("label") == 1, weight).otherwise(F.lit(1.0)))
        learner = LogisticRegression(weightCol="weight", maxIter=max_iter)
    # Every iteration is a job over all rows: few rows are gathered in few tasks, many stay as they are.
    tasks = -(-rows.count() // ROWS_PER_TASK)
    if tasks <= spark.sparkContext.defaultParallelism:
        rows = rows.repartition(max(1, tasks))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return ChurnModel(codes, scaler, learner.fit(rows))
    finally:
        rows.unpersist()


def training_history(model: ChurnModel) -> DataFrame:
    """(epoch, loss) of the optimiser; with ``val_score``, the validation AUC, for a network trained by epochs."""
    m = model.classifier
    if isinstance(m, network.Network):
        return network.history_table(model.scaler.sparkSession, m)
    summary = m.summary() if callable(m.summary) else m.summary
    rows = [(i + 1, float(v)) for i, v in enumerate(summary.objectiveHistory)]
    return model.scaler.sparkSession.createDataFrame(rows, "epoch int, loss double")


def churn_probability(df: DataFrame, model: ChurnModel, out: str = "churn_prob") -> DataFrame:
    ready = _model_inputs(df, model.codes, model.scaler)
    if isinstance(model.classifier, network.Network):
        p = network.probability(model.classifier, vector_to_array("features"), df.sparkSession)
        return ready.withColumn(out, p).select(*df.columns, out)
    scored = model.classifier.transform(ready)
    return scored.withColumn(out, vector_to_array("probability")[1]).select(*df.columns, out)


def tune_threshold(scored: DataFrame, label: str = LABEL, score: str = "churn_prob") -> float:
    scored = durable(scored.select(label, score))
    return float(best_f1_threshold(pr_curve(scored, label, score)).first()["threshold"])


def evaluate_churn(scored: DataFrame, threshold: float, label: str = LABEL, score: str = "churn_prob") -> DataFrame:
    """(metric, value) rows: roc_auc, avg_prec, precision, recall, f1 and the confusion counts."""

    def rows(df: DataFrame, names: dict[str, str]) -> DataFrame:
        pairs = [F.struct(F.lit(n).alias("metric"), F.col(c).cast("double").alias("value")) for c, n in names.items()]
        return df.select(F.inline(F.array(*pairs)))

    scored = durable(scored.select(label, score))
    counts = confusion_metrics(scored, label, F.col(score) > F.lit(threshold))
    parts = [
        rows(roc_auc(scored, label, score), {"auc": "roc_auc"}),
        rows(average_precision(pr_curve(scored, label, score)), {"average_precision": "avg_prec"}),
        rows(counts, {c: c for c in ("precision", "recall", "f1", "tn", "fp", "fn", "tp")}),
    ]
    return reduce(DataFrame.unionByName, parts)


def with_defaults(requests: DataFrame) -> DataFrame:
    """Complete scoring requests: absent fields get defaults, unreadable numbers an ``error`` text."""
    types = {f.name: f.dataType for f in CUSTOMER_SCHEMA}
    filled, problems = {}, []
    for name, default in CUSTOMER_DEFAULTS.items():
        if name not in requests.columns:
            filled[name] = F.lit(default).cast(types[name])
            continue
        value = F.col(name).try_cast(types[name])
        if not isinstance(types[name], T.StringType):
            problems.append(
                F.when(F.col(name).isNotNull() & value.isNull(), F.lit(f"{name} is not a valid number"))
            )
        filled[name] = F.coalesce(value, F.when(F.col(name).isNull(), F.lit(default).cast(types[name])))
    out = requests.withColumn("error", F.coalesce(*problems) if problems else F.lit(None).cast("string"))
    out = out.withColumns(filled)
    return out.withColumn("anomaly_severity_score", rules.severity_score(F.col("anomaly_count_30d")))


def score_customers(requests: DataFrame, model: ChurnModel, threshold: float) -> DataFrame:
    """Probability, decision, band, reasons and action per request; bad requests keep a row with ``error``."""
    scored = churn_probability(with_defaults(requests), model, "_p")
    ok = F.col("error").isNull()
    prob = F.when(ok, steady_round(F.col("_p"), 4))
    return scored.select(
        *[c for c in requests.columns if c not in CUSTOMER_DEFAULTS],
        "contract_type",
        prob.alias("churn_probability"),
        F.when(ok, F.col("_p") > threshold).alias("churn_prediction"),
        F.when(ok, rules.risk_band(F.col("_p"), threshold)).alias("risk_level"),
        F.lit(round(threshold, 4)).alias("threshold"),
        F.when(ok, rules.top_reasons()).alias("top_reasons"),
        F.when(ok, rules.retention_action()).alias("retention_action"),
        "error",
    )


def linear_attribution(
    df: DataFrame, weights: DataFrame, fitted: DataFrame, features: Sequence[str], key: str
) -> DataFrame:
    """(key, feature, attribution) of a linear score on standardised features.

    ``weights`` is one row with a column per feature; attributions sum to score minus mean score.
    """
    w = fitted_row(weights)
    z = standardize(df, fitted, features)
    items = [
        F.struct(F.lit(f).alias("feature"), (F.col(f) * number(w[f])).alias("attribution")) for f in features
    ]
    return z.select(key, F.inline(F.array(*items)))


def attribution_global(local: DataFrame) -> DataFrame:
    """(feature, mean_abs) by falling importance."""
    found = local.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("mean_abs"))
    return found.orderBy(F.col("mean_abs").desc(), "feature")


def sampled_attribution(
    df: DataFrame,
    background: DataFrame,
    features: Sequence[str],
    key: str,
    scorer: Callable[[DataFrame], DataFrame],
    score: str,
    permutations: int = 20,
    seed: int = 42,
    background_rows: int = 100,
) -> DataFrame:
    """(key, feature, attribution) for any scorer, by sampled orders of the features.

    Along each order the features switch one by one from a background row to the explained row; a
    feature's share is the mean change of the score at its switch.  Shares sum to the row's score minus
    the mean score of the background rows.  Every order is walked from each of ``background_rows`` rows of
    ``background``.  Orders share the sets of features that they have switched, so each set is scored once per
    background row, with the weight that it has in all walks.  A row with a missing score on its walks has null shares.
    """
    spark = df.sparkSession
    rng = np.random.default_rng(seed)
    base = uniform_sample(background, hashed(*background.columns, seed=seed), background_rows)
    base = base.select(*features).collect()  # uniform_sample gives background_rows rows at most
    orders = [rng.permutation(len(features)).tolist() for _ in range(permutations)]
    # By set of switched features, how often it stands behind and before the switch of each feature.
    times: dict[frozenset, list[int]] = {}
    for order in orders:
        for k, f in enumerate(order):
            for switched, n in ((frozenset(order[: k + 1]), 1), (frozenset(order[:k]), -1)):
                times.setdefault(switched, [0] * len(features))[f] += n
    plan = spark.createDataFrame(
        [([i in c for i in range(len(features))], [float(n) for n in times[c]]) for c in sorted(times, key=sorted)],
        "_on array<boolean>, _times array<double>",
    )
    rows = spark.createDataFrame(
        [tuple(b) for b in base], T.StructType([T.StructField(f"_b_{f}", df.schema[f].dataType) for f in features])
    )
    runs = df.crossJoin(F.broadcast(rows)).crossJoin(F.broadcast(plan))
    hybrids = runs.withColumns({f: F.when(F.col("_on")[i], F.col(f)).otherwise(F.col(f"_b_{f}")) for i, f in enumerate(features)})
    found = scorer(hybrids).groupBy(key).agg(
        F.count(score).alias("_scored"),
        F.count("*").alias("_all"),
        *[F.sum(F.col(score) * F.col("_times")[i]).alias(f"_s{i}") for i in range(len(features))],
    )
    # Rows that repeat a key share their mean.
    shares = [
        F.struct(
            F.lit(f).alias("feature"),
            F.when(F.col("_scored") == F.col("_all"), F.col(f"_s{i}") * len(times) / (F.col("_all") * len(orders))).alias("attribution"),
        )
        for i, f in enumerate(features)
    ]
    return found.select(key, F.inline(F.array(*shares)))
