"""The paths for hot keys and large sets give the same results as the plain ones."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from telequal.operators import evaluate, features, neighbours, split
from telequal.operators.ordered import exact_quantiles, order_statistics, running_totals
from telequal.operators.panel import forward_fill, join_entity_stats, measure, windowed


@pytest.fixture(scope="module")
def skewed(spark):
    """One entity holds most rows, with uneven gaps; a few others are small."""
    rng = np.random.default_rng(7)
    rows = []
    at = 0
    for i in range(900):
        at += int(rng.integers(1, 50)) if i % 97 else 5000
        rows.append(("hot", at, i, None if rng.random() < 0.4 else float(rng.normal())))
    for e in ("a", "b", "c"):
        for i in range(20):
            rows.append((e, i * 100, i, None if rng.random() < 0.4 else float(rng.normal())))
    df = spark.createDataFrame(rows, "e string, t int, seq int, x double")
    return df.withColumn("ts", F.timestamp_seconds("t")).cache()


def same(a, b, keys):
    pa, pb = (d.toPandas().sort_values(keys).reset_index(drop=True) for d in (a, b))
    pd.testing.assert_frame_equal(pa[sorted(pa)], pb[sorted(pb)], check_exact=False, rtol=1e-9)


ORDER = ("ts", "seq")
BUILDS = {
    "ffill": lambda d, lay: forward_fill(d, lay, ["x"]),
    "std": lambda d, lay: features.rolling_std(d, lay, "x", "o"),
    "rate": lambda d, lay: features.rolling_rate(d, lay, "x", "o"),
    "strict": lambda d, lay: features.rolling_rate(d, lay, "x", "o", strict=True),
    "baseline": lambda d, lay: features.rolling_baseline(d, lay, "x"),
    "seriesfill": lambda d, lay: features.rolling_baseline_seriesfill(d, lay, "x"),
    "risk": lambda d, lay: features.running_risk(
        d, lay, F.coalesce(F.col("x") < -1, F.lit(False)), F.coalesce(F.col("x") < -2, F.lit(False))
    ),
}


@pytest.mark.parametrize("name", BUILDS)
def test_hot_entity_matches_plain_window(skewed, name):
    plain, hot = measure(skewed, "e", ORDER), measure(skewed, "e", ORDER, max_rows=100)
    assert plain.hot is None and [r.e for r in hot.hot.collect()] == ["hot"]
    build = BUILDS[name]
    same(build(skewed, plain), build(skewed, hot), ["e", "seq"])


def test_hot_entity_is_spread_over_blocks(skewed):
    layout = measure(skewed, "e", ORDER, max_rows=100)
    sizes = []

    def build(df, w):
        sizes.append(df.groupBy("e", "_block").count().agg(F.max("count")).first()[0])
        return df

    kept = windowed(skewed, layout, 3, build)
    assert kept.count() == skewed.count()
    assert max(sizes) <= 103


def test_entity_stats_join(skewed):
    stats = skewed.groupBy("e").agg(F.avg("x").alias("m"))
    layout = measure(skewed, "e", ORDER, max_rows=100)
    same(join_entity_stats(skewed, stats, layout), skewed.join(stats, "e"), ["e", "seq"])


@pytest.mark.parametrize("n", [1, 2, 7, 50])
def test_running_totals_for_any_bucket_count(spark, n):
    rng = np.random.default_rng(n)
    vals = np.unique(np.round(rng.exponential(size=300), 3))
    pdf = pd.DataFrame({"k": rng.integers(0, 3, len(vals)), "v": vals, "c": rng.integers(0, 9, len(vals))})
    got = running_totals(spark.createDataFrame(pdf), "v", ["c"], ["k"], n=n).toPandas().sort_values(["k", "v"])
    want = pdf.sort_values(["k", "v"])
    assert got["cum_c"].tolist() == want.groupby("k")["c"].cumsum().tolist()
    assert got["total_c"].tolist() == want.groupby("k")["c"].transform("sum").tolist()


@pytest.mark.parametrize("n", [2, 5, 64])
def test_quantiles_with_a_value_on_a_third_of_all_rows(spark, n):
    rng = np.random.default_rng(n)
    v = np.concatenate([np.full(200, 1.5), rng.normal(size=401)])
    g = rng.integers(0, 2, len(v))
    df = spark.createDataFrame(pd.DataFrame({"g": g, "x": v}))
    got = exact_quantiles(df, ["x"], {"a": 0.25, "b": 0.5, "c": 0.9}, ["g"], n=n).toPandas().set_index("g")
    for k in (0, 1):
        want = pd.Series(v[g == k]).quantile([0.25, 0.5, 0.9]).to_numpy()
        assert np.allclose(got.loc[k, ["a", "b", "c"]].to_numpy(float), want)


def test_order_statistics_bounds(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    r = order_statistics(df, "x", {"first": lambda n: F.lit(0), "last": lambda n: n - 1}).first()
    assert (r.n, r["first"], r["last"]) == (1000, 0.0, 999.0)


@pytest.mark.parametrize("n", [2, 40])
def test_auc_matches_pairs(spark, n):
    rng = np.random.default_rng(3)
    s, y = np.round(rng.random(200), 2), rng.integers(0, 2, 200)
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg)).mean()
    df = spark.createDataFrame(pd.DataFrame({"s": s, "y": y}))
    assert evaluate.roc_auc(df, "y", "s", n=n).first().auc == pytest.approx(want)


def test_ks_matches_numpy(spark):
    rng = np.random.default_rng(4)
    a, b = np.round(rng.normal(size=120), 1), np.round(rng.normal(0.4, 1, 80), 1)
    grid = np.unique(np.concatenate([a, b]))
    cdf = lambda x: np.searchsorted(np.sort(x), grid, side="right") / len(x)
    df = spark.createDataFrame(pd.DataFrame({"x": np.concatenate([a, b]), "b": [False] * 120 + [True] * 80}))
    got = evaluate.ks_drift(df, ["x"], F.col("b"), n=5).first()
    assert got.ks == pytest.approx(np.abs(cdf(a) - cdf(b)).max())


def _brute(q, r, k, skip):
    out = {}
    for i, v in q.items():
        d = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in r.items() if not (skip and i == j))
        out[i] = d[:k]
    return out


@pytest.mark.parametrize("skip", [False, True])
@pytest.mark.parametrize("limit", [10**6, 1])
def test_nearest_neighbours_exact_with_copies(spark, skip, limit):
    rng = np.random.default_rng(5)
    pts = {i: rng.normal(size=3) + 4 * (i % 3) for i in range(150)}
    pts |= {150 + i: np.array([1.0, 2.0, 3.0]) for i in range(60)}  # a third of all rows are one vector
    df = spark.createDataFrame([(i, v.tolist()) for i, v in pts.items()], "id bigint, vec array<double>")
    got = neighbours.knn_join(df, df, 5, skip, shared_doubles=limit, leaf_rows=4).toPandas()
    want = _brute(pts, pts, 5, skip)
    for i, part in got.sort_values("rank").groupby("id"):
        assert np.allclose(part["dist"], [d for d, _ in want[i]])
        assert part["neighbour"].tolist() == [j for _, j in want[i]]
    assert len(got) == 5 * len(pts)


def _lof_brute(pts, k):
    """Local outlier factor of each point without itself, ties broken by id."""
    nn = _brute(pts, pts, k, True)
    kd = {i: n[-1][0] for i, n in nn.items()}
    lrd = {i: 1 / (np.mean([max(d, kd[j]) for d, j in n]) + 1e-10) for i, n in nn.items()}
    return {i: np.mean([lrd[j] for _, j in n]) / lrd[i] for i, n in nn.items()}


def test_lof_matches_brute_force(spark):
    rng = np.random.default_rng(6)
    pts = {i: rng.normal(size=2) for i in range(80)} | {80: np.array([9.0, 9.0])}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in pts.items()], "id bigint, vec array<double>")
    got = {r.id: r.lof for r in neighbours.fit_lof(df, 6).collect()}
    want = _lof_brute(pts, 6)
    assert all(got[i] == pytest.approx(want[i]) for i in pts)
    assert max(got, key=got.get) == 80


def test_lof_treats_copies_as_neighbours(spark):
    rows = [(i, [0.0, 0.0]) for i in range(5)] + [(10 + i, [float(i + 1), 0.0]) for i in range(5)]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>")
    model = {tuple(r.vec): r for r in neighbours.fit_lof(df, 3).collect()}
    assert model[(0.0, 0.0)].m == 5 and model[(0.0, 0.0)].kdist == 0.0
    assert model[(1.0, 0.0)].kdist == 1.0  # two of the three nearest are copies at the origin, or 2,0


def test_splits_are_disjoint_and_keep_shares(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 4 == 0, 1).otherwise(0).alias("y"))
    parts = split.stratified_split(df, "y", split.mix(F.col("id"))).cache()
    n = {(r.split, r.y): r["count"] for r in parts.groupBy("split", "y").count().collect()}
    assert n == {
        ("train", 0): 510, ("val", 0): 90, ("test", 0): 150, ("train", 1): 170, ("val", 1): 30, ("test", 1): 50,
    }
    assert parts.select("id").distinct().count() == 1000
    hashed = split.stratified_split(df, "y", split.hashed("id")).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in hashed} == {"train": 680, "val": 120, "test": 200}


def test_samples_have_exact_sizes(spark):
    df = spark.range(900).select("id", F.when(F.col("id") < 600, 0).otherwise(1).alias("y"))
    got = split.stratified_sample(df, "y", split.hashed("id"), 100).groupBy("y").count().collect()
    assert {r.y: r["count"] for r in got} == {0: 100, 1: 20}
    assert split.stratified_sample(df, "y", split.hashed("id"), 5000).count() == 900
    assert split.uniform_sample(df, split.hashed("id"), 50).count() == 50
