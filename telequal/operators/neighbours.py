"""Exact nearest neighbours and the local outlier factor.

A reference set that fits an executor is sent to all of them.  A larger one is cut by a tree of median cuts into leaves,
whose boxes are measured on the data.  Rows are written once in packed blocks, near ones together.  A task holds a block
of queries while all blocks of references pass by, read from the written table: first the leaves its queries fall into,
then the others.  The distance of the k-th neighbour so far tells which leaves are compared.  The result is exact, a task
holds two blocks, and what is written grows with rows and results, however many leaves a query must see.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telequal.operators.split import hashed
from telequal.schemas import LOF_NEIGHBOURS
from telequal.session import batches_of, broadcast_if_small, durable

# Most doubles of reference vectors that are sent to every executor; the boxes of a tree keep below it as well.
SHARED_DOUBLES = 4_000_000
LEAF_ROWS = 2_000
# Sampled reference rows per leaf, from which the cuts are taken.
SAMPLE_PER_LEAF = 8
# Doubles of the vectors of a packed block; tasks get so many blocks of queries per core at least.
BLOCK_DOUBLES = 1 << 19
BLOCKS_PER_CORE = 4
# Queries that are compared at once.
WALK_ROWS = 256
# Pairs whose exact distances are taken at once.
PAIRS_AT_ONCE = 1 << 16
RESULT = "id bigint, neighbour bigint, dist double"
BLOCK = "lo int, hi int, id binary, leaf binary, vec binary"
# Of Arrow batches of blocks, which are sent one or a few at once.
BATCH_BYTES = 8 << 20
# Of a row without an id.
NO_ID = -(1 << 63)
# Which leaves a pass over the references compares.
HOMES, OTHERS, ALL = 0, 1, 2


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64) if len(vectors) else np.zeros((0, 1))


def _distances(q: np.ndarray, refs: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    out = np.empty(len(row))
    for a in range(0, len(row), PAIRS_AT_ONCE):
        at = slice(a, a + PAIRS_AT_ONCE)
        out[at] = np.sqrt(((q[row[at]] - refs[col[at]]) ** 2).sum(1))
    return out


def _nearest(q: np.ndarray, refs: np.ndarray, ids: np.ndarray, own: np.ndarray | None, k: int):
    """(query row, reference id, distance) of the k nearest per query, ties by id."""
    r_norm = (refs * refs).sum(1)
    step = max(1, 2_000_000 // max(1, len(refs)))
    out_q, out_id, out_d = [], [], []
    for a in range(0, len(q), step):
        part = q[a : a + step]
        q_norm = (part * part).sum(1)
        d2 = q_norm[:, None] + r_norm[None, :] - 2.0 * part @ refs.T
        if own is not None:
            d2[own[a : a + step, None] == ids[None, :]] = np.inf
        kk = min(k, d2.shape[1])
        kth = np.partition(d2, kk - 1, axis=1)[:, kk - 1]
        near = d2 <= (kth + 1e-9 * (q_norm + r_norm.max()))[:, None]
        row, col = np.nonzero(near & np.isfinite(d2))
        dist = _distances(part, refs, row, col)
        order = np.lexsort((ids[col], dist, row))
        row, col, dist = row[order], col[order], dist[order]
        first = np.searchsorted(row, row, side="left")
        keep = np.arange(len(row)) - first < k
        out_q.append(row[keep] + a)
        out_id.append(ids[col[keep]])
        out_d.append(dist[keep])
    if not out_q:
        return np.zeros(0, int), np.zeros(0, ids.dtype), np.zeros(0)
    return np.concatenate(out_q), np.concatenate(out_id), np.concatenate(out_d)


def _shared(queries: DataFrame, refs: DataFrame, k: int, skip_self: bool) -> DataFrame:
    rows = refs.select("id", "vec").toPandas()  # bounded by SHARED_DOUBLES, checked by the caller
    shared = queries.sparkSession.sparkContext.broadcast((rows["id"].to_numpy(), _matrix(rows["vec"])))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, mat = shared.value
        for b in batches:
            if len(b) and len(ids):
                own = b["id"].to_numpy()
                q, n, d = _nearest(_matrix(b["vec"]), mat, ids, own if skip_self else None, k)
                yield pd.DataFrame({"id": own[q], "neighbour": n, "dist": d})

    return queries.select("id", "vec").mapInPandas(run, RESULT)


class CutTree:
    """Median cuts of a sample, as a heap: node i has the children 2i and 2i + 1, and the leaves are the last level."""

    def __init__(self, sample: np.ndarray, levels: int) -> None:
        self.levels = levels
        self.dim, self.cut = np.zeros(1 << levels, np.int64), np.zeros(1 << levels)
        rows = {1: np.arange(len(sample))}
        for node in range(1, 1 << levels):
            at = rows.pop(node)
            if len(at):
                x = sample[at]
                self.dim[node] = int(np.ptp(x, axis=0).argmax())
                values = x[:, self.dim[node]]
                self.cut[node] = np.median(values)
                if self.cut[node] == values.max():  # equal values from the middle on: cut below them
                    below = values[values < self.cut[node]]
                    self.cut[node] = below.max() if len(below) else self.cut[node]
                right = values > self.cut[node]
                rows[2 * node], rows[2 * node + 1] = at[~right], at[right]
            else:
                rows[2 * node] = rows[2 * node + 1] = at

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row, from 0."""
        node, row = np.ones(len(x), np.int64), np.arange(len(x))
        for _ in range(self.levels):
            node = 2 * node + (x[row, self.dim[node]] > self.cut[node])
        return node - (1 << self.levels)


class Boxes:
    """For every node of a tree the smallest box around its rows, and how many these are."""

    def __init__(self, levels: int, leaf: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        self.levels, size = levels, 2 << levels
        self.n = np.zeros(size, np.int64)
        self.low, self.high = np.full((size, low.shape[1]), np.inf), np.full((size, low.shape[1]), -np.inf)
        at = leaf + (1 << levels)
        self.n[at], self.low[at], self.high[at] = n, low, high
        for level in range(levels - 1, -1, -1):
            up = np.arange(1 << level, 2 << level)
            self.n[up] = self.n[2 * up] + self.n[2 * up + 1]
            self.low[up] = np.minimum(self.low[2 * up], self.low[2 * up + 1])
            self.high[up] = np.maximum(self.high[2 * up], self.high[2 * up + 1])

    def home(self, leaf: np.ndarray, need: int) -> np.ndarray:
        """The smallest node above each leaf with ``need`` rows, or the root."""
        node = leaf + (1 << self.levels)
        while (small := (self.n[node] < need) & (node > 1)).any():
            node = np.where(small, node // 2, node)
        return node

    def leaves(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf): the leaves with rows below each node."""
        row = np.arange(len(node))
        while len(node) and node[0] < (1 << self.levels):
            deep = node >= (1 << self.levels)
            row = np.concatenate((row[deep], np.repeat(row[~deep], 2)))
            node = np.concatenate((node[deep], (2 * node[~deep][:, None] + [0, 1]).ravel()))
            order = np.argsort(node, kind="stable")  # inner nodes first
            row, node = row[order], node[order]
        some = self.n[node] > 0
        return row[some], node[some] - (1 << self.levels)

    def below_homes(self, leaf: np.ndarray, need: int) -> np.ndarray:
        """The leaves with rows below the homes of some leaves."""
        return np.unique(self.leaves(np.unique(self.home(np.unique(leaf).astype(np.int64), need)))[1])

    def gap(self, x: np.ndarray, leaf: int) -> np.ndarray:
        """Distance of every row from the box of a leaf."""
        at = leaf + (1 << self.levels)
        out = np.maximum(np.maximum(self.low[at] - x, x - self.high[at]), 0.0)
        return np.sqrt((out * out).sum(1))

    def within(self, x: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf): the leaves whose boxes are no farther from a row than its limit, from the root down."""
        row, node = np.arange(len(x)), np.ones(len(x), np.int64)
        for level in range(self.levels + 1):
            there = self.n[node] > 0
            row, node = row[there], node[there]
            gap = np.maximum(np.maximum(self.low[node] - x[row], x[row] - self.high[node]), 0.0)
            near = np.sqrt((gap * gap).sum(1)) <= limit[row]
            row, node = row[near], node[near]
            if level < self.levels:
                row, node = np.repeat(row, 2), (2 * node[:, None] + [0, 1]).ravel()
        return row, node - (1 << self.levels)


def _levels(n_refs: int, width: int, leaf_rows: int, shared_doubles: int) -> int:
    """Levels of a tree with leaves of about ``leaf_rows`` rows whose boxes, two corners a node, may be sent to tasks."""
    wanted = int(np.ceil(np.log2(max(1.0, n_refs / leaf_rows))))
    most = int(np.log2(max(2.0, shared_doubles / (4 * max(1, width)))))
    return max(0, min(wanted, most))


def _packed(ids: np.ndarray, leaf: np.ndarray, x: np.ndarray) -> pd.DataFrame:
    """One row of :data:`BLOCK`; vectors of single precision stay so."""
    single = x.astype(np.float32)
    vec = single if (single == x).all() else x
    row = [leaf.min(), leaf.max(), ids.tobytes(), leaf.tobytes(), vec.tobytes()]
    return pd.DataFrame([row], columns=["lo", "hi", "id", "leaf", "vec"])


def _unpacked(block: Sequence[pa.Scalar], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, leaves and vectors of a block."""
    ids, leaf, vec = (x.as_buffer() for x in block)
    ids, leaf = np.frombuffer(ids, np.int64), np.frombuffer(leaf, np.int32)
    kind = np.float64 if len(vec) == 8 * width * len(ids) else np.float32
    return ids, leaf, np.frombuffer(vec, kind).reshape(len(ids), -1).astype(np.float64)


class Asked:
    """A block of queries while references pass by: the k nearest so far, and which leaves each slice must see."""

    def __init__(self, ids: np.ndarray, leaf: np.ndarray, x: np.ndarray, boxes: Boxes, k: int, skip_self: bool) -> None:
        self.ids, self.x, self.boxes, self.k, self.skip_self = ids, x, boxes, k, skip_self
        self.norm = (x * x).sum(1)
        self.wide = np.column_stack((x, np.ones(len(x))))
        self.dist, self.found = np.full((len(x), k), np.inf), np.zeros((len(x), k), np.int64)
        self.starts = range(0, len(x), WALK_ROWS)
        self.home = np.zeros((len(self.starts), 1 << boxes.levels), bool)
        for s, a in enumerate(self.starts):
            self.home[s, boxes.below_homes(leaf[a : a + WALK_ROWS], k + skip_self)] = True
        self.near: np.ndarray | None = None

    def _reach(self) -> np.ndarray:
        """Leaves that a slice may need: in reach of a ball that holds those of its queries."""
        near = np.zeros_like(self.home)
        for s, a in enumerate(self.starts):
            x, limit = self.x[a : a + WALK_ROWS], self.dist[a : a + WALK_ROWS, -1]
            real = np.isfinite(x).all(axis=1)  # others have no distances
            if real.any():
                centre = x[real].mean(axis=0)
                far = (np.sqrt(((x[real] - centre) ** 2).sum(1)) + limit[real]).max()
                near[s, self.boxes.within(centre[None], np.array([far + 1e-7 * (1.0 + far)]))[1]] = True
        return near

    def see(self, ids: np.ndarray, leaf: np.ndarray, refs: np.ndarray, which: int, rows: int) -> None:
        """Compare with a block of references, at most ``rows`` of a leaf at once."""
        if which == OTHERS and self.near is None:
            self.near = self._reach()
        half = (refs * refs).sum(1) / 2
        if not (real := np.isfinite(half)).all():
            ids, leaf, refs, half = ids[real], leaf[real], refs[real], half[real]
        if not len(ids):
            return
        wide = np.column_stack((refs, -half))
        edge = np.flatnonzero(np.concatenate(([True], leaf[1:] != leaf[:-1])))
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(leaf)]):
            at = leaf[a]
            wanted = {HOMES: self.home[:, at], ALL: np.ones(len(self.starts), bool)}.get(which)
            if wanted is None:
                wanted = self.near[:, at] & ~self.home[:, at]
            for s in np.flatnonzero(wanted).tolist():
                for c in range(a, b, rows):
                    part = slice(c, min(b, c + rows))
                    self._compare(s, int(at), ids[part], refs[part], wide[part], 2.0 * half[part].max())

    def _compare(self, s: int, leaf: int, ids: np.ndarray, refs: np.ndarray, wide: np.ndarray, most: float) -> None:
        row = np.arange(self.starts[s], min(self.starts[s] + WALK_ROWS, len(self.x)))
        row = row[self.boxes.gap(self.x[row], leaf) <= (limit := self.dist[row, -1]) + 1e-7 * (1.0 + limit)]
        limit = self.dist[row, -1]
        open_, row, limit = row[np.isinf(limit)], row[np.isfinite(limit)], limit[np.isfinite(limit)]
        if len(row):
            # |q - r|^2 <= b is q.r - |r|^2 / 2 >= (|q|^2 - b) / 2.
            bound = limit * limit + 1e-9 * (self.norm[row] + most)
            near = self.wide[row] @ wide.T >= ((self.norm[row] - bound) / 2)[:, None]
            i, j = np.divmod(np.flatnonzero(near), len(ids))
            if len(i) > 4 * self.k * len(row):  # bounds from far away
                open_ = np.concatenate((open_, row))
            elif len(i):
                d = _distances(self.x[row], refs, i, j)
                ok = d <= limit[i]
                if self.skip_self:
                    ok &= (self.ids[row[i]] != ids[j]) | (ids[j] == NO_ID)
                self._merge(row[i[ok]], ids[j[ok]], d[ok])
        if len(open_):
            own = np.where(self.ids[open_] == NO_ID, NO_ID + 1, self.ids[open_]) if self.skip_self else None
            i, n, d = _nearest(self.x[open_], refs, ids, own, self.k)
            self._merge(open_[i], n, d)

    def _merge(self, row: np.ndarray, ids: np.ndarray, dist: np.ndarray) -> None:
        if not len(row):
            return
        some, at = np.unique(row, return_inverse=True)
        at = np.concatenate((np.repeat(np.arange(len(some)), self.k), at))
        ids, dist = np.concatenate((self.found[some].ravel(), ids)), np.concatenate((self.dist[some].ravel(), dist))
        order = np.lexsort((ids, dist, at))
        keep = order[np.arange(len(at)) - np.searchsorted(at[order], at[order]) < self.k]
        self.found[some], self.dist[some] = ids[keep].reshape(-1, self.k), dist[keep].reshape(-1, self.k)

    def result(self) -> pa.RecordBatch:
        row, rank = np.nonzero(np.isfinite(self.dist))
        ids, found = self.ids[row], self.found[row, rank]
        columns = [pa.array(ids, mask=ids == NO_ID), pa.array(found, mask=found == NO_ID), pa.array(self.dist[row, rank])]
        return pa.RecordBatch.from_arrays(columns, names=["id", "neighbour", "dist"])


def _by_tree(
    queries: DataFrame, refs: DataFrame, k: int, skip_self: bool, n_refs: int, width: int, leaf_rows: int, shared: int
) -> DataFrame:
    spark = queries.sparkSession
    cores = spark.sparkContext.defaultParallelism
    n_queries = n_refs if queries is refs else queries.count()
    size = max(1, min(BLOCK_DOUBLES // width, max(WALK_ROWS, n_queries // (BLOCKS_PER_CORE * cores))))
    # Of identical vectors only the first k+1 ids can be among the k nearest.
    copies = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = refs.select("id", "vec").withColumn("_c", copies).where(F.col("_c") <= k + 1).drop("_c")
    levels = _levels(n_refs, width, leaf_rows, shared)
    share = min(1.0, (SAMPLE_PER_LEAF << levels) / n_refs)  # a sample in proportion to the boxes, which are bounded
    picked = refs.where(hashed("id") < F.lit(share * 2.0**53)).select("vec").toPandas()
    tree = spark.sparkContext.broadcast(CutTree(_matrix(picked["vec"]).reshape(len(picked), -1), levels).__dict__)

    def cuts() -> CutTree:
        t = CutTree.__new__(CutTree)
        t.__dict__.update(tree.value)
        return t

    @F.pandas_udf("int")
    def leaf_of(vec: pd.Series) -> pd.Series:
        return pd.Series(cuts().leaf(_matrix(vec)).astype("int32"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for b in batches:
            while len(b):
                part, b = b.iloc[: size - n], b.iloc[size - n :]
                held.append((part["id"].to_numpy(np.int64), part["leaf"].to_numpy(np.int32), _matrix(part["vec"])))
                n += len(part)
                if n == size:
                    yield _packed(*map(np.concatenate, zip(*held)))
                    held, n = [], 0
        if held:
            yield _packed(*map(np.concatenate, zip(*held)))

    def packed(rows: DataFrame, n: int) -> DataFrame:
        """Blocks of at most ``size`` rows in the order of their leaves; a task makes about four."""
        placed = rows.select(F.coalesce("id", F.lit(NO_ID)).alias("id"), "vec", leaf_of("vec").alias("leaf"))
        dealt = placed.repartitionByRange(max(1, n // (4 * size)), "leaf", F.xxhash64("id")).sortWithinPartitions("leaf")
        return durable(dealt.mapInPandas(pack, BLOCK))

    blocks = packed(few, n_refs)

    def corners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*(b.column(c) for c in ("id", "leaf", "vec"))):
                _, leaf, x = _unpacked(row, width)
                real = np.isfinite((x * x).sum(1))  # others have no distances
                leaf, x = leaf[real], x[real]
                there, first, n = np.unique(leaf, return_index=True, return_counts=True)
                ends = [f.reduceat(x, first).tolist() if len(x) else [] for f in (np.minimum, np.maximum)]
                yield pa.RecordBatch.from_pydict({"leaf": there, "n": n, "low": ends[0], "high": ends[1]}, schema=measures)

    measures = pa.schema({"leaf": pa.int32(), "n": pa.int64(), "low": pa.list_(pa.float64()), "high": pa.list_(pa.float64())})
    ends = [f(F.get(c, F.lit(i))).alias(f"{c}{i}") for c, f in (("low", F.min), ("high", F.max)) for i in range(width)]
    # At most 2^levels rows, whose corners ``shared`` bounds.
    with batches_of(spark, BATCH_BYTES):
        found = blocks.mapInArrow(corners, "leaf int, n bigint, low array<double>, high array<double>")
        measured = found.groupBy("leaf").agg(F.sum("n").alias("n"), *ends).toPandas()
    low, high = (measured[[f"{c}{i}" for i in range(width)]].to_numpy(np.float64) for c in ("low", "high"))
    boxes = Boxes(levels, measured["leaf"].to_numpy(np.int64), measured["n"].to_numpy(np.int64), low, high)
    sent = spark.sparkContext.broadcast(boxes.__dict__)

    def sizes() -> Boxes:
        b = Boxes.__new__(Boxes)
        b.__dict__.update(sent.value)
        return b

    @F.pandas_udf("lo int, hi int")
    def homes(leaf: pd.Series) -> pd.DataFrame:
        below = [sizes().below_homes(np.frombuffer(x, np.int32), k + skip_self) for x in leaf]
        return pd.DataFrame([(x.min(), x.max()) if len(x) else (0, -1) for x in below], columns=["lo", "hi"]).astype("int32")

    asked = blocks if queries is refs and boxes.n[1] == n_refs else packed(queries, n_queries)
    n_asked = max(1, asked.count())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes, seen = sizes(), {}
        for b in batches:
            for i in range(b.num_rows):
                key, which = b.column("key")[i].as_py(), b.column("which")[i].as_py()
                if key not in seen:
                    ids, leaf, x = _unpacked([b.column(f"q_{c}")[i] for c in ("id", "leaf", "vec")], width)
                    seen[key] = Asked(ids.copy(), leaf, x, boxes, k, skip_self)
                seen[key].see(*_unpacked([b.column(c)[i] for c in ("id", "leaf", "vec")], width), which, 2 * leaf_rows)
        for x in seen.values():
            yield x.result()

    with batches_of(spark, BATCH_BYTES):
        key = F.monotonically_increasing_id().alias("key")
        home = homes("leaf")
        held = asked.select(key, home["lo"].alias("q_lo"), home["hi"].alias("q_hi"), *[F.col(c).alias(f"q_{c}") for c in ("id", "leaf", "vec")])
        held = held.repartitionByRange(n_asked, "key")
        # Partitions of the left side pass by every block of the right side, in order, without a shuffle.
        several = -(-BLOCKS_PER_CORE * cores // n_asked)
        if several > 1 and n_asked < cores:  # few queries: their tasks share the references
            passing = blocks.withColumn("which", F.lit(ALL)).coalesce(several)
        else:
            passing = blocks.withColumn("which", F.lit(HOMES)).unionByName(blocks.withColumn("which", F.lit(OTHERS))).coalesce(1)
        wanted = (F.col("which") != HOMES) | ((F.col("lo") <= F.col("q_hi")) & (F.col("hi") >= F.col("q_lo")))
        pairs = passing.hint("shuffle_replicate_nl").join(held, wanted)
        return durable(pairs.mapInArrow(search, RESULT))


def knn_join(
    queries: DataFrame,
    refs: DataFrame,
    k: int,
    skip_self: bool = False,
    shared_doubles: int = SHARED_DOUBLES,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """(id, rank, neighbour, dist): the k nearest references of every query, ties by neighbour id.

    Both frames have ``id`` (bigint) and ``vec`` (array of doubles).
    """
    shape = refs.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d")).first()
    if shape.n * (shape.d or 0) <= shared_doubles:
        found = _shared(queries, refs, k, skip_self)
    else:
        found = _by_tree(queries, refs, k, skip_self, shape.n, shape.d, leaf_rows, max(shared_doubles, 64 * shape.d))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("dist", "neighbour"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("id", "rank", "neighbour", "dist")


def _weighted(pairs: DataFrame, copies: DataFrame, k: int) -> DataFrame:
    """Add ``w``: how many of the k neighbours the copies of each neighbour make up, nearest first.

    ``copies`` has (id, m).  Rank 0 stands for the row's own other copies.
    """
    before = Window.partitionBy("id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    there = broadcast_if_small(copies.select(F.col("id").alias("neighbour"), F.col("m").alias("_m")))
    taken = F.lit(k) - F.coalesce(F.sum("_m").over(before), F.lit(0))
    return (
        pairs.join(there, "neighbour")
        .withColumn("_m", F.col("_m") - F.when(F.col("rank") == 0, 1).otherwise(0))
        .withColumn("w", F.least(F.col("_m"), taken))
        .where("w > 0")
        .select("id", "neighbour", "dist", "w")
    )


def _self_pairs(distinct: DataFrame, k: int) -> DataFrame:
    """Weighted neighbours of every distinct vector; its own copies come first, at distance 0."""
    own = distinct.where("m > 1").select(
        "id", F.lit(0).alias("rank"), F.col("id").alias("neighbour"), F.lit(0.0).alias("dist")
    )
    return _weighted(knn_join(distinct, distinct, k, skip_self=True).unionByName(own), distinct, k)


def _mean(c: Column) -> Column:
    return F.sum(c * F.col("w")) / F.sum("w")


def fit_lof(refs: DataFrame, k: int = LOF_NEIGHBOURS) -> DataFrame:
    """(id, vec, m, kdist, lrd, lof) per distinct reference vector, ``m`` being its number of copies.

    A vector with very many copies is one weighted row.  ``lof`` scores the vector without itself.
    """
    distinct = durable(refs.groupBy("vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("m")))
    pairs = durable(_self_pairs(distinct, k))
    kdist = pairs.groupBy("id").agg(F.max("dist").alias("kdist"))
    reach = pairs.join(kdist.withColumnRenamed("id", "neighbour"), "neighbour").groupBy("id")
    lrd = reach.agg((F.lit(1.0) / (_mean(F.greatest("dist", "kdist")) + F.lit(1e-10))).alias("lrd"))
    near = pairs.join(lrd.withColumnsRenamed({"id": "neighbour", "lrd": "_lrd"}), "neighbour")
    around = near.groupBy("id").agg(_mean(F.col("_lrd")).alias("_around"))
    return durable(
        distinct.join(kdist, "id")
        .join(lrd, "id")
        .join(around, "id")
        .select("id", "vec", "m", "kdist", "lrd", (F.col("_around") / F.col("lrd")).alias("lof"))
    )


def lof_score(queries: DataFrame, model: DataFrame, k: int = LOF_NEIGHBOURS) -> DataFrame:
    """(id, lof) of new rows against the fitted reference set; large values are outliers."""
    pairs = _weighted(knn_join(queries, model, k), model, k)
    near = broadcast_if_small(model.select(F.col("id").alias("neighbour"), "kdist", F.col("lrd").alias("_lrd")))
    own_density = F.lit(1.0) / (_mean(F.greatest("dist", "kdist")) + F.lit(1e-10))
    return pairs.join(near, "neighbour").groupBy("id").agg((_mean(F.col("_lrd")) / own_density).alias("lof"))


def vector(features: Sequence[str]) -> Column:
    return F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features])


def fit_row_lof(df: DataFrame, features: Sequence[str], k: int = LOF_NEIGHBOURS) -> DataFrame:
    """:func:`fit_lof` on the feature columns of rows that have no integer key."""
    return fit_lof(df.select(F.monotonically_increasing_id().alias("id"), vector(features).alias("vec")), k)


def row_lof(
    df: DataFrame, model: DataFrame, features: Sequence[str], out: str = "lof", k: int = LOF_NEIGHBOURS
) -> DataFrame:
    """Add the outlier factor of every row; rows with equal features are scored once."""
    vecs = df.select(vector(features).alias("vec")).distinct()
    vecs = durable(vecs.withColumn("id", F.monotonically_increasing_id()))
    scores = vecs.join(lof_score(vecs, model, k), "id").select("vec", F.col("lof").alias(out))
    return df.withColumn("vec", vector(features)).join(scores, "vec").drop("vec")
