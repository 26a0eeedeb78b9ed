"""Mixing sources to target weights by soft membership, in built-in functions only.

A classifier learned from the labelled table gives every document a posterior over domains.  A document that is
used at rate r adds r * tokens * posterior to the domains' expected token totals.  The rates are the least-squares
solution, with a lower bound, that brings these totals to target * corpus tokens.  It is the projection of
1 - posterior . multipliers to the bound; the multipliers, one per domain, are found by damped Newton steps on the
convex dual problem: each step is one distributed sum over a narrow table.

The residual is measured in the inverse of the domains' token cross-moments (with a ridge), and a very small pull
towards rate 1 keeps rates finite where a target is out of reach.  The bound is positive, so that a clean document which
looks toxic is thinned out but not lost; it never uses more than half of a target.  Domains with less than
``LEAST_SHARE`` of the tokens cannot be raised by rates; their targets go to the others in proportion.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telequal.llm import words as w
from telequal.session import durable

#: Domains are the combinations of the two labels, with the share of tokens that each should have.
DOMAINS = ("poor, clean", "poor, toxic", "good, clean", "good, toxic")
TARGETS = (0.05, 0.005, 0.93, 0.015)
BINS = 1 << 13
LABELLED_ROWS = 20_000
SHARPNESS = 60.0
MOST_STEPS = 40
#: What may be left of the gradient, as a share of the smallest target.
TOLERANCE = 1e-6
PULL = 1e-5
RIDGE = 0.02
LEAST_SHARE = 1e-3
#: Lower bound of rates, and the share of any target that documents at the bound may use.
LEAST_RATE, BOUND_SHARE = 0.05, 0.5


def fit_domains(docs: DataFrame, labels: DataFrame, bins: int = BINS, rows: int = LABELLED_ROWS):
    """Log prior of each domain and log likelihood of each hashed word in it, from at most ``rows`` labelled rows."""
    k = len(DOMAINS)
    chosen = w.labelled_sample(labels, ["quality", "toxic"], rows)
    counted = (
        docs.select("doc_id", w.spaced_words(w.text_of()).alias("_words"))
        .join(chosen, "doc_id")
        .select((F.col("quality") * 2 + F.col("toxic")).alias("domain"), F.col("_words"))
    )
    n = np.zeros((k, bins))
    for r in (
        counted.select("domain", F.explode(w.hashed_words("_words", bins)).alias("bin"))
        .groupBy("domain", "bin").count().collect()  # at most domains x bins rows
    ):
        if 0 <= r["domain"] < k:
            n[r["domain"], r["bin"]] = r["count"]
    prior = np.log((n.sum(axis=1) + 1) / (n.sum() + k))
    pooled = (n.sum(axis=0) + 1) / (n.sum() + bins)
    likelihood = np.log((n + bins * pooled) / (n.sum(axis=1, keepdims=True) + bins))
    return prior.tolist(), (likelihood - np.log(pooled)).tolist()


def posteriors(docs: DataFrame, model, sharpness: float = SHARPNESS) -> DataFrame:
    """``docs`` with ``tokens`` and ``posterior``: soft, as evidence counts per word, not per text.

    A null or empty text has no tokens and the prior as its posterior.
    """
    prior, weights = model
    out = docs.withColumn("_words", w.spaced_words(w.text_of()))
    out = out.withColumn("_bins", w.hashed_words("_words", len(weights[0]))).withColumn("tokens", F.size("_words").cast("long"))
    out = out.withColumn(
        "_logits",
        F.array(
            *[
                F.lit(p) + F.lit(sharpness) * w.summed("_bins", ws) / F.greatest(F.col("tokens"), F.lit(1))
                for p, ws in zip(prior, weights)
            ]
        ),
    )
    out = out.withColumn("_odds", F.transform("_logits", lambda x: F.exp(x - F.array_max("_logits"))))
    total = F.aggregate("_odds", F.lit(0.0), lambda s, x: s + x)
    return out.withColumn("posterior", F.transform("_odds", lambda x: x / total)).drop("_words", "_bins", "_logits", "_odds")


def _plain(multipliers) -> Column:
    """1 - posterior . multipliers, the rate before it is projected to the bound."""
    out = F.lit(1.0)
    for d, x in enumerate(multipliers):
        out = out - F.get("posterior", F.lit(d)) * F.lit(float(x))
    return out


def rate_of(fitted: tuple[float, list[float]] | None) -> Column:
    """A document's rate by the bound and the multipliers of ``fit_rates``; 1 without any."""
    return F.lit(1.0) if fitted is None else F.greatest(F.lit(fitted[0]), _plain(fitted[1]))


def fit_rates(members: DataFrame, targets=TARGETS, most_steps: int = MOST_STEPS, tolerance: float = TOLERANCE):
    """(bound, multipliers) for ``members`` (``tokens``, ``posterior``); None if there are no tokens."""
    k = len(targets)
    p = [F.get("posterior", F.lit(d)) for d in range(k)]
    t = F.col("tokens").cast("double")

    def moments(weight: Column) -> list[Column]:
        return [F.sum(weight * p[i] * p[j]).alias(f"m{i}_{j}") for i in range(k) for j in range(i, k)]

    def square(row) -> np.ndarray:
        return np.array([[row[f"m{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]) / total

    first = members.agg(F.sum(t).alias("total"), *[F.sum(t * x).alias(f"d{i}") for i, x in enumerate(p)], *moments(t)).first()
    total = first["total"]
    if not total:
        return None
    share = np.array([first[f"d{i}"] for i in range(k)]) / total
    metric = PULL * (square(first) + RIDGE * np.eye(k))
    present = share >= LEAST_SHARE
    goal = np.where(present, np.asarray(targets, float), 0.0)
    goal = np.where(present, goal / max(goal.sum(), 1e-12) * (1 - share[~present].sum()), share)
    bound = min(LEAST_RATE, BOUND_SHARE * float((goal[present] / share[present]).min()))

    def judged(at: np.ndarray):
        """Value of the dual problem, its descent direction, and its curvature, by one sum over the members."""
        z, low = _plain(at), F.lit(bound)
        row = members.agg(
            F.sum(t * F.when(z > low, z * z / 2).otherwise(low * z - low * low / 2)).alias("value"),
            *[F.sum(t * F.greatest(low, z) * x).alias(f"d{i}") for i, x in enumerate(p)],
            *moments(F.when(z > low, t).otherwise(0.0)),
        ).first()
        used = np.array([row[f"d{i}"] for i in range(k)]) / total
        return row["value"] / total + goal @ at + at @ metric @ at / 2, used - goal - metric @ at, square(row) + metric

    wanted = tolerance * goal[goal > 0].min()
    at, (value, slope, curve) = np.zeros(k), judged(np.zeros(k))
    for _ in range(most_steps):
        if np.abs(slope).max() <= wanted:
            break
        step = np.linalg.solve(curve, slope)
        fall = slope @ step
        while True:
            after = judged(at + step)
            if after[0] <= value - 0.1 * fall or fall <= 1e-14:
                break
            step, fall = step / 2, fall / 2
        at, (value, slope, curve) = at + step, after
    return bound, [float(f"{x:.12g}") for x in at]


def mixed(docs: DataFrame, labels: DataFrame, targets=TARGETS, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``tokens``, ``rate`` and ``copies`` (the rate rounded by a hash of the id, so that copies sum to
    rates on average).  Every row is returned with its rate; a rate is 0 only if a target is 0.

    A null or empty text has no tokens and keeps the rate of its posterior.  Repeated rows have equal rates.  If no
    target can be met (empty table, no labels) all rates are what the fit reaches, 1 without any tokens.  Columns of
    ``docs`` named like the added ones are replaced.
    """
    own = {c: f"_own{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    base = docs.withColumnsRenamed(own)
    scored = posteriors(base, fit_domains(docs, labels))
    members = durable(scored if keep_text else scored.drop("text"))
    fitted = fit_rates(members.select("tokens", "posterior"), targets)
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    out = members.withColumn("rate", rate_of(fitted))
    out = out.withColumn("copies", F.floor(F.col("rate") + draw).cast("long"))
    kept = [c for c in docs.columns if c not in ("tokens", "posterior", "rate", "copies") and (keep_text or c != "text")]
    return out.select(*[F.col(own.get(c, c)).alias(c) for c in kept], "tokens", "posterior", "rate", "copies")
