"""Isolation forest, anomaly ensemble and permutation importance."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from telequal.operators.evaluate import roc_auc
from telequal.operators.ordered import exact_quantiles, fitted_row, number, running_totals
from telequal.operators.split import MIX_PRIME, mix
from telequal.operators.stats import fit_minmax, minmax_norm
from telequal.schemas import ANOMALY_SHARE, IF_SAMPLE, IF_TREES, IF_WEIGHT, LOF_WEIGHT
from telequal.session import durable

# Rows drawn per wanted row, so that every tree fills up.
DRAW_MARGIN = 1.5
EULER_GAMMA = 0.5772156649015329
# Offsets of the seed, so that drawing, dealing, ranking and cutting are shuffled differently.
DRAW, DEAL, RANK, PICK, CUT, PERMUTE = 1, 1_000, 100_000, 7, 8, 9
# Features whose differences one whole number marks.
MASK_BITS = 60
# Numbers of nodes of one tree, below any of the next.
TREE_STEP = 1_000_003


def path_constant(n: float) -> float:
    """Mean path length of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (np.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def key_number(df: DataFrame, keys: Sequence[str]) -> Column:
    """A whole number per row: the key itself if it is one, else a hash of the keys."""
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, IntegralType):
        return F.col(keys[0]).cast("bigint")
    return F.xxhash64(*keys)


def _tree_sample(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], trees: int, sample: int, seed: int
) -> DataFrame:
    """(tree, x): ``sample`` rows per tree, chosen by an arithmetic hash in one pass; a missing value is 0."""
    n = df.count()
    wanted = DRAW_MARGIN * sample
    groups = int(max(1, min(trees, n // wanted)))
    rounds = -(-trees // groups)
    share = min(1.0, wanted * groups / n) if n else 1.0
    x = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features])
    # In every round a row falls to one tree at most; a large table needs one round and a small share.
    turn = F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("_turn")
    key = F.col("_key")
    drawn = (
        df.select(key_number(df, keys).alias("_key"), x.alias("x"))
        .where(mix(key, seed + DRAW) < F.lit(share * MIX_PRIME))
        .select("*", turn)
        .withColumn("tree", (F.col("_turn") * groups + mix(key, F.col("_turn") + (seed + DEAL)) % groups).cast("int"))
        .where(F.col("tree") < trees)
        # At most about DRAW_MARGIN * trees * sample rows; a tree grows in one task, many trees in many.
        .repartition(min(trees, df.sparkSession.sparkContext.defaultParallelism), "tree")
    )
    w = Window.partitionBy("tree").orderBy(mix(key, F.col("tree") + (seed + RANK)), "_key", "x")
    return drawn.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= sample).select("tree", "x")


def _path_constant(n: Column) -> Column:
    many = F.lit(2.0) * (F.log(n - F.lit(1.0)) + F.lit(EULER_GAMMA)) - F.lit(2.0) * (n - F.lit(1.0)) / n
    return F.when(n <= 1, F.lit(0.0)).when(n == 2, F.lit(1.0)).otherwise(many)


def _grown(rows: DataFrame, width: int, sample: int, seed: int) -> DataFrame:
    """(tree, _path): per sampled row the nodes it passes, as structs (node, n, feature, cut); root 1, children 2i and 2i + 1.

    Rows are partitioned by tree once; every level is a window over (tree, node) in the same partitions.
    """
    nothing = F.array().cast("array<struct<node:int,n:bigint,feature:int,cut:double>>")
    whole = Window.partitionBy("tree")
    size = F.count(F.lit(1)).over(whole)
    grown = rows.withColumns({"_limit": F.ceil(F.log2(F.greatest(size, F.lit(2)))), "node": F.lit(1), "_path": nothing})
    w = Window.partitionBy("tree", "node")
    features = [F.sequence(F.lit(k), F.lit(min(k + MASK_BITS, width) - 1)) for k in range(0, width, MASK_BITS)]

    def bit(i: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), i % MASK_BITS)

    def differs(mask: Column, i: Column) -> Column:
        return mask.bitwiseOR(F.when(F.get("x", i) != F.get("_one", i), bit(i)).otherwise(F.lit(0).cast("bigint")))

    for level in range(int(np.ceil(np.log2(max(sample, 2)))) + 1):
        at = F.col("tree").cast("bigint") * TREE_STEP + F.col("node")
        # A feature can be cut if some row of the node differs in it from any one row: a bit per feature, whatever their number.
        grown = grown.withColumns({"_n": F.count(F.lit(1)).over(w), "_one": F.first("x").over(w)})
        masks = [F.bit_or(F.aggregate(f, F.lit(0).cast("bigint"), differs)).over(w) for f in features]
        grown = grown.withColumn("_masks", F.array(*masks))
        live = F.filter(
            F.sequence(F.lit(0), F.lit(width - 1)),
            lambda i: F.get("_masks", F.floor(i / MASK_BITS).cast("int")).bitwiseAND(bit(i)) != 0,
        )
        grown = grown.withColumn("_live", live).withColumn(
            "_f",
            F.when(
                (F.lit(level) < F.col("_limit")) & (F.col("_n") > 1) & (F.size("_live") > 0),
                F.get("_live", (mix(at, seed + PICK) % F.greatest(F.size("_live"), F.lit(1))).cast("int")),
            ),
        )
        own = F.get("x", F.col("_f"))
        grown = grown.withColumns({"_lo": F.min(own).over(w), "_hi": F.max(own).over(w)})
        share = mix(at, seed + CUT) / F.lit(float(MIX_PRIME))
        grown = grown.withColumn("_c", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * share)
        step = F.struct("node", F.col("_n").alias("n"), F.col("_f").alias("feature"), F.col("_c").alias("cut"))
        grown = grown.withColumns(
            {
                "_path": F.when(F.col("node").isNotNull(), F.array_append("_path", step)).otherwise(F.col("_path")),
                "node": F.when(
                    F.col("_f").isNotNull(),
                    F.col("node") * 2 + F.when(F.get("x", F.col("_f")) <= F.col("_c"), 0).otherwise(1),
                ),
            }
        ).drop("_n", "_one", "_masks", "_lo", "_hi", "_live", "_f", "_c")
    return grown.select("tree", "_path")


def fit_isolation_forest(
    df: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    trees: int = IF_TREES,
    sample: int = IF_SAMPLE,
    seed: int = 42,
) -> DataFrame:
    """Tree nodes as a small table (tree, node, feature, threshold, left, right, path), grown level by level in expressions.

    Which rows a tree sees, which feature a node cuts and where follow from arithmetic hashes of key, tree and node, so the
    same forest grows anywhere.  Values up to the threshold go left.  A leaf has feature -1, leads to itself, and its path is
    its depth plus the mean path of a search among the rows that it holds.
    """
    rows = _tree_sample(df, features, keys, trees, sample, seed)
    passed = _grown(rows, len(features), sample, seed).select("tree", F.explode("_path").alias("p"))
    nodes = passed.groupBy("tree", "p.node").agg(
        F.max("p.n").alias("n"), F.max("p.feature").alias("feature"), F.max("p.cut").alias("threshold")
    )
    leaf = F.col("feature").isNull()
    depth = F.floor(F.log2(F.col("node").cast("double") + 0.5))
    return durable(
        nodes.select(
            "tree",
            "node",
            F.coalesce("feature", F.lit(-1)).alias("feature"),
            F.coalesce("threshold", F.lit(0.0)).alias("threshold"),
            F.when(leaf, F.col("node")).otherwise(F.col("node") * 2).alias("left"),
            F.when(leaf, F.col("node")).otherwise(F.col("node") * 2 + 1).alias("right"),
            F.when(leaf, depth + _path_constant(F.col("n"))).otherwise(F.lit(0.0)).alias("path"),
        )
    )


def isolation_score(
    df: DataFrame, model: DataFrame, features: Sequence[str], out: str = "if_score", sample: int = IF_SAMPLE
) -> DataFrame:
    """Add 2^(-mean path / c(sample)) in (0, 1]; larger means more isolated.

    The model has at most trees * (2 * sample - 1) nodes, which is what travels to the tasks.
    """
    rows = model.orderBy("tree", "node").toPandas()
    starts = rows.index[~rows["tree"].duplicated()].to_numpy()
    leaf = rows["feature"].to_numpy() < 0
    name = rows["tree"].to_numpy(np.int64) * TREE_STEP + rows["node"].to_numpy(np.int64)
    below = [np.searchsorted(name, rows["tree"].to_numpy(np.int64) * TREE_STEP + rows[c]) for c in ("right", "left")]
    nodes = {
        # A leaf leads back to itself, so all rows walk the same number of steps.
        "feature": np.where(leaf, 0, rows["feature"]).astype(np.int64),
        "threshold": np.where(leaf, np.inf, rows["threshold"]),
        "next": np.column_stack(below).astype(np.int64).ravel(),
        "path": rows["path"].to_numpy(),
        "roots": starts,
    }
    shared = df.sparkSession.sparkContext.broadcast(nodes)
    norm, depth, width = path_constant(sample), int(np.ceil(np.log2(max(sample, 2)))), len(features)

    @F.pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        m = shared.value
        x = np.column_stack([c.fillna(0.0).to_numpy(np.float64) for c in cols]).ravel()
        row = np.arange(len(cols[0])) * width
        total = np.zeros(len(row))
        for root in m["roots"]:
            at = np.full(len(row), root)
            for _ in range(depth):
                at = m["next"][2 * at + (x[row + m["feature"][at]] <= m["threshold"][at])]
            total += m["path"][at]
        return pd.Series(np.power(2.0, -(total / len(m["roots"])) / norm))

    return df.withColumn(out, score(*[F.col(f).cast("double") for f in features]))


def ensemble_score(
    df: DataFrame,
    limits: DataFrame,
    if_col: str = "if_score",
    lof_col: str = "lof",
    out: str = "ensemble",
    weights: tuple[float, float] = (IF_WEIGHT, LOF_WEIGHT),
) -> DataFrame:
    """Weighted mean of both scores, scaled by limits that were fitted on training rows."""
    scaled = minmax_norm(df, limits, [if_col, lof_col], "_01")
    blend = F.col(f"{if_col}_01") * weights[0] + F.col(f"{lof_col}_01") * weights[1]
    return scaled.withColumn(out, blend).drop(f"{if_col}_01", f"{lof_col}_01")


def fit_ensemble(train: DataFrame, if_col: str = "if_score", lof_col: str = "lof") -> DataFrame:
    return fit_minmax(train, [if_col, lof_col])


def percentile_threshold(scored: DataFrame, score: str, share: float = ANOMALY_SHARE) -> float:
    """Threshold without labels: the score that ``share`` of the training rows stay below."""
    return float(fitted_row(exact_quantiles(scored, [score], {"cut": share}))["cut"])


def permuted(df: DataFrame, features: Sequence[str], keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Every row once per feature (``shuffled``), with that feature taken from another row.

    The partner is the next row in hash order (the last takes the first), so one ranking by hash serves
    all features and no row order is gathered in one task.
    """
    src = df.withColumn("_h", mix(key_number(df, keys), seed + PERMUTE).cast("double")).withColumn("_one", F.lit(1))
    # Positions of distinct hashes; rows that share a hash follow each other.
    per_hash = src.groupBy("_h").agg(F.count(F.lit(1)).alias("_c"))
    placed = running_totals(per_hash, "_h", ["_c"], fit_on=src.select("_h"))
    inside = Window.partitionBy("_h").orderBy(*keys)
    ranked = src.join(placed.select("_h", "_c", "cum__c", "total__c"), "_h").withColumn(
        "_pos", F.col("cum__c") - F.col("_c") + F.row_number().over(inside) - 1
    )
    donor = ranked.select(
        F.pmod(F.col("_pos") - 1, F.col("total__c")).alias("_pos"), *[F.col(f).alias(f"_d_{f}") for f in features]
    )
    both = ranked.select(*df.columns, "_pos").join(donor, "_pos")
    names = F.explode(F.array(*[F.lit(f) for f in features])).alias("shuffled")
    wide = both.select("*", names)
    return wide.withColumns(
        {f: F.when(F.col("shuffled") == f, F.col(f"_d_{f}")).otherwise(F.col(f)) for f in features}
    ).select(*df.columns, "shuffled")


def permutation_importance(
    df: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    label: str,
    scorer: Callable[[DataFrame], DataFrame],
    score: str,
    seed: int = 42,
) -> DataFrame:
    """(feature, auc, drop): fall of the AUC when a feature is shuffled, all features in one job.

    ``scorer`` adds the column ``score``; it sees the untouched rows too, as feature ``''``.
    """
    rows = df.withColumn("shuffled", F.lit("")).unionByName(permuted(df, features, keys, seed))
    scored = durable(scorer(rows).select("shuffled", label, score))
    aucs = durable(roc_auc(scored, label, score, ["shuffled"]))
    base = number(fitted_row(aucs.where("shuffled = ''"))["auc"])
    return aucs.where("shuffled <> ''").select(
        F.col("shuffled").alias("feature"), "auc", (base - F.col("auc")).alias("drop")
    )


def decide(score: Column, threshold: float | Column) -> Column:
    return score > (threshold if isinstance(threshold, Column) else F.lit(float(threshold)))
