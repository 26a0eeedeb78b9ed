"""Hard negatives by the threshold algorithm over sorted lists, one per dimension.

Vectors are whole numbers, a score is their inner product with the anchor.  All rows are dealt into blocks and all
anchors into chunks of bounded size; a task holds one block and one chunk.  In a block every dimension has the list of
its rows by value.  An anchor reads all lists in step, from the high end where its own component is positive and from
the low end where it is negative; each row met is scored in full.  The components at the reading heads bound every row
not met yet, and reading stops once that bound is strictly below the lowest score that still counts, so that ties are
never lost.  The best rows of all blocks are merged by windows that limit themselves inside each map task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telequal.session import durable

#: Most components in a block of rows, and most anchors in a chunk.
BLOCK_VALUES = 1 << 19
CHUNK_ANCHORS = 512
#: Rows that the heads read of each list before the first look at the bound, and how much deeper each next look is.
FIRST_DEPTH, DEEPER = 16, 4
#: Products and sums below this are exact in doubles; beyond it Python integers are used.
EXACT = 1 << 53
LONG = (1 << 63) - 1


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled with 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    out = np.zeros((len(column), width), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


class Lists:
    """Rows of a block with one sorted list per dimension."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        self.order = np.ascontiguousarray(np.argsort(rows, axis=0, kind="stable").T.astype(np.int32))
        self.most = int(np.abs(rows.astype(object)).max()) if rows.size else 0
        self.real = rows.astype(np.float64)

    def scan(self, anchor: np.ndarray):
        """Growing sets of scored rows: (indices, their scores, bound of all other rows or None when none is left)."""
        n, width = self.rows.shape
        exact = self.most * int(np.abs(anchor.astype(object)).max(initial=0)) * max(1, width) < EXACT
        kind = np.float64 if exact else object
        rows, weights = self.real if exact else self.rows.astype(object), anchor.astype(kind)
        high, low = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        up, down = self.order[high], self.order[low]
        met, scores = np.zeros(n, bool), np.zeros(n, kind)
        depth = 0
        while n:
            last, depth = depth, min(n, DEEPER * depth or FIRST_DEPTH)
            before = met.copy()
            if len(high) + len(low) == 0:
                met[:] = True
            else:
                met[up[:, n - depth : n - last]] = True
                met[down[:, last:depth]] = True
            fresh = np.flatnonzero(met & ~before)
            scores[fresh] = rows[fresh] @ weights
            if depth == n or met.all():
                yield np.arange(n), scores, None
                return
            bound = (rows[up[:, n - depth], high] * weights[high]).sum() + (rows[down[:, depth - 1], low] * weights[low]).sum()
            seen = np.flatnonzero(met)
            yield seen, scores[seen], bound


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k highest scores, ties by smaller id, in that order."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= kth)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def best(lists: Lists, ids: np.ndarray, own: int, anchor: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(id, score) of the first k rows other than ``own``."""
    for seen, scores, bound in lists.scan(anchor):
        other = ids[seen] != own
        seen, scores = seen[other], scores[other]
        found = _first(ids[seen], scores, k)
        if bound is None or (len(found) == k and bound < scores[found[-1]]):
            return [(int(ids[seen[i]]), int(scores[i])) for i in found]
    return []


def best_in_windows(
    lists: Lists, ids: np.ndarray, apart: np.ndarray, anchor: np.ndarray, windows: list[tuple[int, int]], k: int
) -> list[list[tuple[int, int]]]:
    """For each (low, high): (id, score) of the first k rows among ``apart`` whose score is inside."""
    out: list[list[tuple[int, int]] | None] = [None] * len(windows)
    for seen, scores, bound in lists.scan(anchor):
        able = apart[seen]
        rows, scored = seen[able], scores[able]
        for w, (low, high) in enumerate(windows):
            if out[w] is not None:
                continue
            inside = np.flatnonzero((scored >= low) & (scored <= high))
            found = inside[_first(ids[rows[inside]], scored[inside], k)]
            # No other row can enter: all are below the k-th score, or below the window.
            if bound is None or bound < (scored[found[-1]] if len(found) == k else low):
                out[w] = [(int(ids[rows[i]]), int(scored[i])) for i in found]
        if None not in out:
            break
    return [x or [] for x in out]


def _long(x: int) -> int:
    return max(-LONG - 1, min(LONG, x))


def _rows(names: list[str], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.table({n: pa.array([_long(v) for v in c], pa.int64()) for n, c in zip(names, columns)})


def _positives(width: int, k: int):
    def run(anchors: pa.Table, block: pa.Table) -> pa.Table:
        found = []
        labels, ids = (block.column(c).to_numpy() for c in ("label", "id"))
        own, of = anchors.column("id").to_numpy(), anchors.column("label").to_numpy()
        vec, rows = _matrix(anchors.column("vec"), width), _matrix(block.column("vec"), width)
        for label in np.unique(of):
            alike = np.flatnonzero(labels == label)
            lists = Lists(rows[alike])
            for i in np.flatnonzero(of == label):
                found += [(own[i], j, s) for j, s in best(lists, ids[alike], own[i], vec[i], k)]
        return _rows(["anchor_id", "positive_id", "positive_score"], found)

    return run


def _negatives(width: int, k: int, low: int, high: int):
    def run(anchors: pa.Table, block: pa.Table) -> pa.Table:
        found = []
        labels, ids = (block.column(c).to_numpy() for c in ("label", "id"))
        lists = Lists(_matrix(block.column("vec"), width))
        vec = _matrix(anchors.column("vec"), width)
        own, of = anchors.column("id").to_numpy(), anchors.column("label").to_numpy()
        for i, positives in enumerate(anchors.column("positives").to_pylist()):
            # low * p <= 100 * score <= high * p in whole numbers.
            windows = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in positives]
            for p, rows in zip(positives, best_in_windows(lists, ids, labels != of[i], vec[i], windows, k)):
                found += [(own[i], p["id"], p["score"], j, s) for j, s in rows]
        return _rows(["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"], found)

    return run


def whole_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(id, label, vec): usable rows of (id, label, embedding), each component x as floor(scale * x).

    Rows with a null id or label, a null vector, or any null or non-finite component are left out.  Of rows that share
    an id the one with the smallest label, then vector, counts.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))
    usable = rows.select(F.col("id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    usable = usable.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    one = usable.select("id", F.struct("label", whole.alias("vec")).alias("_r")).groupBy("id").agg(F.min("_r").alias("_r"))
    return one.select("id", "_r.label", "_r.vec")


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), rank from 1.

    ``rows`` is what :func:`whole_vectors` gives; ``is_anchor`` picks the anchors by their columns.  An anchor's positives
    are its first ``positives`` other rows of its label, the negatives of each are the first ``negatives`` rows of other
    labels whose score is between ``low`` and ``high`` percent of the positive's; higher scores come first, ties by
    smaller id, and there are fewer where fewer exist.  Shorter vectors count as filled with 0.  Scores are exact; those
    beyond 64 bits are returned as the largest or smallest 64-bit number.  An empty table gives an empty result.
    """
    rows = durable(rows.select("id", "label", "vec"))
    shape = rows.agg(F.max(F.size("vec")).alias("width"), F.count_if(is_anchor).alias("anchors")).first()
    width = max(1, shape["width"] or 0)
    # Of equal vectors of one label only the first ids can be among the first k rows.
    copies = F.row_number().over(Window.partitionBy("label", "vec").orderBy("id"))
    kept = durable(rows.withColumn("_c", copies).where(F.col("_c") <= max(positives + 1, negatives)).drop("_c"))
    n_blocks = -(-max(1, kept.count()) // max(1, BLOCK_VALUES // width))
    n_chunks = -(-max(1, shape["anchors"]) // CHUNK_ANCHORS)

    def every(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    def dealt(n: int, name: str, seed: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(n)).cast("int").alias(name)

    where = ["block", "chunk"]
    blocks = kept.select("*", dealt(n_blocks, "block", 1)).select("*", every(n_chunks, "chunk")).groupBy(*where)
    anchors = rows.where(is_anchor)

    def against_all(left: DataFrame, task, schema: str) -> DataFrame:
        asked = left.select("*", dealt(n_chunks, "chunk", 2)).select("*", every(n_blocks, "block"))
        return asked.groupBy(*where).cogroup(blocks).applyInArrow(task, schema)

    def first(df: DataFrame, keys: list[str], score: str, by: str, k: int) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), by)
        return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    schema = "anchor_id long, positive_id long, positive_score long"
    near = against_all(anchors, _positives(width, positives), schema)
    near = first(near, ["anchor_id"], "positive_score", "positive_id", positives)
    wanted = near.groupBy(F.col("anchor_id").alias("id")).agg(  # at most ``positives`` each
        F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives")
    )
    asking = durable(anchors.join(wanted, "id"))
    found = against_all(
        asking, _negatives(width, negatives, low, high), f"{schema}, negative_id long, negative_score long"
    )
    found = first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
