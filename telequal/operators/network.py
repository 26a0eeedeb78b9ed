"""A dense network trained by epochs: ReLU layers, one sigmoid output, Adam, class weights, early stop.

One epoch is one job.  Every task takes mini-batches from its own rows, from the state that the driver sends; the states
of all tasks, weighted by their rows, are averaged in two levels (so that the driver meets few of them) and go out again.
With one task this is plain mini-batch Adam.  The same job scores the held-out rows with the state it started from and
returns counts per score bin, from which the validation AUC follows.  The state is a few hundred kilobytes, whatever the
table's size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telequal.operators.split import hashed

# Training settings of the churn network, and the share of training rows held out to stop on.
LEARNING_RATE, BATCH_ROWS, MOST_EPOCHS, PATIENCE = 0.001, 32, 100, 15
HELD_OUT = 0.15
BETA_1, BETA_2, TINY = 0.9, 0.999, 1e-8
# Bins of the score in which validation rows are counted; rows of one bin count as ties.
SCORE_BINS = 2_000
ROWS_PER_TASK = 10_000


@dataclass(frozen=True)
class Network:
    """Layer sizes, the flat weights of the best epoch, and (epoch, loss, val_score) of all epochs."""

    sizes: tuple[int, ...]
    weights: np.ndarray
    history: tuple[tuple[int, float, float], ...]


def _shapes(sizes: Sequence[int]) -> list[tuple[int, int, int]]:
    """(start, inputs, outputs) of each layer in the flat weights: a matrix, then its biases."""
    out, at = [], 0
    for n, m in zip(sizes, sizes[1:]):
        out.append((at, n, m))
        at += (n + 1) * m
    return out


def _layers(flat: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(flat[a : a + n * m].reshape(n, m), flat[a + n * m : a + (n + 1) * m]) for a, n, m in _shapes(sizes)]


def initial(sizes: Sequence[int], seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = [np.concatenate((rng.normal(0.0, np.sqrt(2.0 / n), n * m), np.zeros(m))) for _, n, m in _shapes(sizes)]
    return np.concatenate(parts)


def forward(flat: np.ndarray, sizes: Sequence[int], x: np.ndarray) -> list[np.ndarray]:
    """Outputs of every layer, the input first; the last is a column of probabilities."""
    out = [x]
    layers = _layers(flat, sizes)
    for k, (w, b) in enumerate(layers):
        z = out[-1] @ w + b
        out.append(np.maximum(z, 0.0) if k < len(layers) - 1 else 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0))))
    return out


def gradient(flat: np.ndarray, sizes: Sequence[int], x: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """(weighted mean log loss, its gradient) over some rows."""
    out = forward(flat, sizes, x)
    p, share = out[-1][:, 0], weight / weight.sum()
    loss = -(share * (y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12))).sum()
    grad, back = np.empty_like(flat), (share * (p - y))[:, None]
    for k, ((a, n, m), (w, _)) in reversed(list(enumerate(zip(_shapes(sizes), _layers(flat, sizes))))):
        grad[a : a + n * m] = (out[k].T @ back).ravel()
        grad[a + n * m : a + (n + 1) * m] = back.sum(0)
        if k:
            back = (back @ w.T) * (out[k] > 0)
    return float(loss), grad


def _epoch(state, sizes: tuple[int, ...], rate: float, batch_rows: int, seed: int, epoch: int):
    """One row per task: rows, summed loss, the state after its mini-batches, and score counts of held-out rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, first, second, steps = (np.array(v) for v in state.value)
        start, rng = flat.copy(), np.random.default_rng([seed, epoch])
        counts, n, loss, t = np.zeros((2, SCORE_BINS), np.int64), 0, 0.0, int(steps)
        for batch in batches:
            if not len(batch):
                continue
            x = np.array(batch.column("x").flatten()).reshape(len(batch), sizes[0])
            y, weight = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "weight"))
            held = batch.column("held").to_numpy(zero_copy_only=False)
            if held.any():
                p = forward(start, sizes, x[held])[-1][:, 0]
                np.add.at(counts, (y[held].astype(int), np.minimum((p * SCORE_BINS).astype(int), SCORE_BINS - 1)), 1)
            order = rng.permutation(np.flatnonzero(~held))
            for a in range(0, len(order), batch_rows):
                at = order[a : a + batch_rows]
                one, grad = gradient(flat, sizes, x[at], y[at], weight[at])
                t += 1
                first = BETA_1 * first + (1 - BETA_1) * grad
                second = BETA_2 * second + (1 - BETA_2) * grad * grad
                flat -= rate * (first / (1 - BETA_1**t)) / (np.sqrt(second / (1 - BETA_2**t)) + TINY)
                n, loss = n + len(at), loss + one * len(at)
        moved = np.concatenate((flat, first, second, [t])) * n
        yield pa.RecordBatch.from_pydict(
            {"n": pa.array([n], pa.int64()), "loss": [loss], "moved": [moved.tobytes()], "counts": [counts.tobytes()]}
        )

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, loss, moved, counts = 0, 0.0, None, None
    for batch in batches:
        for r in batch.to_pylist():
            n, loss = n + r["n"], loss + r["loss"]
            m, c = np.frombuffer(r["moved"]), np.frombuffer(r["counts"], np.int64)
            moved, counts = (m, c) if moved is None else (moved + m, counts + c)
    if moved is not None:
        yield pa.RecordBatch.from_pydict(
            {"n": pa.array([n], pa.int64()), "loss": [loss], "moved": [moved.tobytes()], "counts": [counts.tobytes()]}
        )


_PART = "n long, loss double, moved binary, counts binary"


def binned_auc(counts: np.ndarray) -> float:
    """Area under the curve from counts (label, bin); rows of one bin are ties.  0.5 if a class is missing."""
    neg, pos = counts
    if not neg.sum() or not pos.sum():
        return 0.5
    below = np.cumsum(neg) - neg / 2.0
    return float((pos * below).sum() / (pos.sum() * neg.sum()))


def fit_network(
    rows: DataFrame,
    features: Column,
    label: str,
    keys: Sequence[str],
    hidden: Sequence[int],
    epochs: int = MOST_EPOCHS,
    patience: int = PATIENCE,
    rate: float = LEARNING_RATE,
    batch_rows: int = BATCH_ROWS,
    held_out: float = HELD_OUT,
    seed: int = 42,
) -> Network:
    """Train on ``rows``: ``features`` is an array of doubles, ``label`` 0 or 1, ``keys`` name a row.

    A share ``held_out`` (by hash of the keys) is not trained on.  Training ends after ``epochs``, or when the validation AUC
    has not risen for ``patience`` epochs; the weights of the best epoch are kept.  Positive rows weigh as many times as
    there are negative ones for each.  Rows without a label or with a missing feature take no part.
    """
    spark = rows.sparkSession
    usable = rows.select(*keys, features.alias("x"), F.col(label).cast("double").alias("y"))
    usable = usable.where(F.col("y").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))
    shape = usable.agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg"), F.max(F.size("x")).alias("d")).first()
    if not shape["pos"] or not shape["neg"]:
        raise ValueError("a network needs training rows of both classes")
    sizes = (int(shape["d"]), *hidden, 1)
    weight = F.when(F.col("y") == 1, F.lit(shape["neg"] / shape["pos"])).otherwise(F.lit(1.0))
    tasks = max(1, -(-(shape["pos"] + shape["neg"]) // ROWS_PER_TASK))
    order = hashed(*keys, seed=seed)
    kept = usable.select(
        "x", "y", weight.alias("weight"), (hashed(*keys, seed=seed + 1) < F.lit(held_out * 2.0**53)).alias("held"), order.alias("_o")
    )
    # Dealt and ordered by hash, so that tasks are alike and a lost one is rebuilt as it was.
    kept = kept.repartition(tasks, "_o").sortWithinPartitions("_o", "x").drop("_o").persist(StorageLevel.MEMORY_AND_DISK)
    flat = initial(sizes, seed)
    now = (flat, np.zeros_like(flat), np.zeros_like(flat), np.zeros(1))
    best, best_at, best_score, history = flat, 0, -1.0, []
    try:
        for epoch in range(epochs + 1):  # the last job only scores the last state
            sent = spark.sparkContext.broadcast((now[0], now[1], now[2], now[3][0]))
            parts = kept.mapInArrow(_epoch(sent, sizes, rate if epoch < epochs else 0.0, batch_rows, seed, epoch), _PART)
            if tasks > 16:
                parts = parts.repartition(int(np.sqrt(tasks)) + 1).mapInArrow(_summed, _PART)
            whole = next(_summed([parts.toArrow().combine_chunks().to_batches()[0]])).to_pylist()[0]
            sent.unpersist()
            score = binned_auc(np.frombuffer(whole["counts"], np.int64).reshape(2, SCORE_BINS))
            if epoch:  # the held-out rows were scored with what the epoch before has left
                history[-1] = (*history[-1][:2], score)
                if score > best_score:
                    best, best_at, best_score = now[0], epoch, score
                elif epoch - best_at >= patience:
                    break
            if epoch < epochs:
                history.append((epoch + 1, whole["loss"] / max(1, whole["n"]), 0.0))
                moved = np.frombuffer(whole["moved"]) / max(1, whole["n"])
                m = len(flat)
                now = (moved[:m], moved[m : 2 * m], moved[2 * m : 3 * m], moved[3 * m :])
    finally:
        kept.unpersist()
    return Network(sizes, np.array(best), tuple(history))


def history_table(spark, network: Network) -> DataFrame:
    """(epoch, loss, val_score) of every epoch."""
    return spark.createDataFrame(list(network.history), "epoch int, loss double, val_score double")


def probability(network: Network, features: Column, spark) -> Column:
    """Probability of the label, from an array of doubles; null where a feature is missing."""
    sent, sizes = spark.sparkContext.broadcast(network.weights), network.sizes

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="float64")
        rows = np.array(x.tolist(), dtype=np.float64)
        out = forward(sent.value, sizes, np.nan_to_num(rows))[-1][:, 0]
        return pd.Series(np.where(np.isnan(rows).any(axis=1), np.nan, out))

    return F.nullif(score(features), F.lit(float("nan")))
