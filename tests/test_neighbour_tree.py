"""The tree of cuts behind the exact neighbour join: its boxes, its walks, and how few leaves a query visits."""

from __future__ import annotations

import numpy as np
import pytest

from telequal.operators import neighbours
from telequal.operators.neighbours import Boxes, CutTree


def built(x: np.ndarray, levels: int, sample: int | None = None):
    tree = CutTree(x[: sample or len(x)], levels)
    leaf = tree.leaf(x)
    there = np.unique(leaf)
    low, high = (np.array([f(x[leaf == k], axis=0) for k in there]) for f in (np.min, np.max))
    return tree, leaf, Boxes(levels, there, np.bincount(leaf)[there], low, high)


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(20_000, 10)) * np.array([5, 4, 3, 2, 1, 0.5, 0.3, 0.2, 0.1, 0.1])
    x[:, 9] = rng.integers(0, 2, 20_000)  # a flag
    return x


def test_leaves_are_even_and_boxes_hold_their_rows(points):
    tree, leaf, boxes = built(points, 7, sample=1024)
    sizes = np.bincount(leaf, minlength=128)
    assert sizes.sum() == 20_000 and sizes.max() < 4 * 20_000 / 128
    assert boxes.n[1] == 20_000
    for level in range(8):
        node = (leaf + 128) >> level
        assert (points >= boxes.low[node]).all() and (points <= boxes.high[node]).all()


def test_walk_finds_exactly_the_leaves_in_reach(points):
    _, _, boxes = built(points, 7)
    x, limit = points[:40] + 0.01, np.linspace(0.0, 3.0, 40)
    row, leaf = boxes.within(x, limit)
    low, high = boxes.low[128:], boxes.high[128:]
    for i in range(40):
        gap = np.maximum(np.maximum(low - x[i], x[i] - high), 0)
        want = np.flatnonzero((np.sqrt((gap**2).sum(1)) <= limit[i]) & (boxes.n[128:] > 0))
        assert sorted(leaf[row == i]) == want.tolist()


def test_queries_visit_few_leaves(points):
    """Ten features, leaves of 156 rows: far below a scan, and less than k log n rows' worth of leaves."""
    tree, leaf, boxes = built(points, 7)
    k, q = 20, points[::200]
    d = np.sqrt(((q[:, None, :] - points[None, :, :]) ** 2).sum(2))
    kth = np.sort(d, axis=1)[:, k]
    row, _ = boxes.within(q, kth)
    visits = np.bincount(row, minlength=len(q))
    assert visits.mean() < 128 * 0.35 and visits.mean() < k * np.log2(len(points)) / 4


def test_home_climbs_until_there_are_enough_rows():
    x = np.arange(64.0)[:, None]
    tree, leaf, boxes = built(x, 4)
    assert (boxes.n[16:] == 4).all()
    assert boxes.home(leaf[:1], 4)[0] == 16 and boxes.home(leaf[:1], 5)[0] == 8 and boxes.home(leaf[:1], 1000)[0] == 1
    row, below = boxes.leaves(np.array([8, 17, 1]))
    assert sorted(zip(row.tolist(), below.tolist())) == [(0, 0), (0, 1), (1, 1)] + [(2, k) for k in range(16)]


@pytest.mark.parametrize("kind", ["equal", "few values", "one outlier"])
def test_trees_of_awkward_rows(kind):
    x = np.zeros((500, 3))
    if kind == "few values":
        x = np.random.default_rng(0).integers(0, 2, (500, 3)).astype(float)
    if kind == "one outlier":
        x[0] = 1e12
    _, leaf, boxes = built(x, 5)
    assert boxes.n[1] == 500 and len(leaf) == 500
    row, found = boxes.within(x[:5], np.zeros(5))
    assert all(leaf[i] in found[row == i] for i in range(5))


def test_empty_sample_gives_one_leaf():
    tree = CutTree(np.zeros((0, 2)), 3)
    assert set(tree.leaf(np.array([[1.0, 2.0], [3.0, 4.0]]))) <= set(range(8))


@pytest.mark.parametrize("width", [4, 30])
def test_join_by_tree_equals_shared(spark, width):
    rng = np.random.default_rng(width)
    refs = [(i, rng.normal(size=width).round(1).tolist()) for i in range(900)]
    refs += [(10_000 + i, [0.5] * width) for i in range(100)]
    asked = [(i, rng.normal(size=width).round(1).tolist()) for i in range(80)] + [(99_999, [1e6] * width)]
    r, q = (spark.createDataFrame(x, "id bigint, vec array<double>") for x in (refs, asked))
    whole = neighbours.knn_join(q, r, 7).toPandas().sort_values(["id", "rank"], ignore_index=True)
    cut = neighbours.knn_join(q, r, 7, shared_doubles=1, leaf_rows=20).toPandas().sort_values(["id", "rank"], ignore_index=True)
    assert whole["neighbour"].tolist() == cut["neighbour"].tolist() and len(whole) == 81 * 7
    assert np.allclose(whole["dist"], cut["dist"])


def test_levels_follow_rows_and_stay_below_the_bound():
    assert neighbours._levels(1_000, 10, 2_000, 4_000_000) == 0
    assert neighbours._levels(2_000_000, 10, 2_000, 4_000_000) == 10
    most = neighbours._levels(10**12, 10, 2_000, 4_000_000)
    assert (2 << most) * 10 * 2 <= 4_000_000
