"""The neighbour join of large sets in packed blocks: what it writes, and rows that are odd."""

from __future__ import annotations

import os

import numpy as np
import pytest

import __spark_entry__ as contract
from telequal.operators import neighbours
from telequal.session import shared_dir


def _written(spark) -> int:
    top = shared_dir(spark).removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(top) for f in names)


def _frame(spark, ids, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "id bigint, vec array<double>")


def _nearest(q, x, ids, k):
    d = np.sqrt(((q[None] - x) ** 2).sum(1))
    order = np.lexsort((ids, d))[:k]
    return ids[order].tolist(), d[order]


def test_written_bytes_follow_rows_not_visits(spark):
    """Random vectors of 32 dimensions, of which boxes tell nothing: every query sees nearly all of 128 leaves."""
    x = np.random.default_rng(3).normal(size=(3_000, 32))
    df = _frame(spark, range(len(x)), x)
    before = _written(spark)
    got = neighbours.knn_join(df, df, 5, skip_self=True, shared_doubles=20_000, leaf_rows=20).toPandas()
    assert _written(spark) - before < 4 * (x.nbytes + 24 * len(got))
    got = got.sort_values(["id", "rank"])
    for i in range(0, 3_000, 100):
        ids, d = _nearest(x[i], np.delete(x, i, 0), np.delete(np.arange(len(x)), i), 5)
        part = got[got["id"] == i]
        assert part["neighbour"].tolist() == ids and np.allclose(part["dist"], d)


@pytest.mark.parametrize("walk", [256, 8])  # one block of queries, whose tasks share the references; or many blocks
def test_odd_rows_in_blocks(spark, monkeypatch, walk):
    """Ids that are missing or repeat, values that are missing, copies, and points far from the origin."""
    monkeypatch.setattr(neighbours, "WALK_ROWS", walk)
    rng = np.random.default_rng(4)
    x = np.concatenate((rng.normal(size=(300, 6)), rng.normal(size=(300, 6)) + 1e5, np.zeros((50, 6))))
    ids = np.arange(len(x))
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x)] + [(None, (x[0] + 1e-3).tolist()), (9_000, [float("nan")] * 6)]
    refs = spark.createDataFrame(rows, "id bigint, vec array<double>")
    asked = spark.createDataFrame([*rows[:650:10], (None, x[1].tolist()), (9_000, [float("nan")] * 6)], "id bigint, vec array<double>")
    got = neighbours.knn_join(asked, refs, 4, shared_doubles=1, leaf_rows=10).toPandas().sort_values(["id", "rank"])
    x, ids = np.concatenate((x, x[:1] + 1e-3)), np.append(ids, -1)
    for i in range(0, 650, 10):
        want, d = _nearest(x[i], x, ids, 4)
        part = got[got["id"] == i]
        assert part["neighbour"].fillna(-1).tolist() == want and np.allclose(part["dist"], d)
    none = got[got["id"].isna()]
    assert none["neighbour"].tolist() == _nearest(x[1], x, ids, 4)[0]
    assert 9_000 not in got["id"].tolist() and 9_000 not in got["neighbour"].tolist()


@pytest.mark.parametrize("name", ["lof_score", "lof_novelty", "ensemble_score"])
def test_outlier_queries_of_large_sets(spark, monkeypatch, tmp_path, name):
    """As with a reference set that fits an executor, and without a row per query and leaf."""
    x = np.random.default_rng(5).normal(size=(1_500, 64)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist(), i % 10) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    rows.write.parquet(f"{tmp_path}/embeddings.parquet")
    run = contract.queries()[name]
    whole = run(spark, str(tmp_path)).toPandas().sort_values("id", ignore_index=True)
    monkeypatch.setattr(neighbours.knn_join, "__defaults__", (False, 20_000, 20))
    before = _written(spark)
    cut = run(spark, str(tmp_path)).toPandas().sort_values("id", ignore_index=True)
    assert _written(spark) - before < 15 * x.nbytes
    score = cut.columns[1]
    assert len(cut) == len(whole) > 0 and np.allclose(cut[score], whole[score], atol=2e-6)
    assert cut.drop(columns=score).equals(whole.drop(columns=score))
