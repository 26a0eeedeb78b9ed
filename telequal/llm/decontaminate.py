"""Benchmark decontamination with suffix arrays over shards of the training texts.

Every task turns its share of the documents into shards of word suffixes, sorts them into a suffix array and
binary-searches the suffixes of all benchmark items in it.  Only suffixes that begin with two words that begin
some benchmark suffix are sorted; no other suffix can match.  The benchmark is a stated query set: it travels to
the tasks in blocks of at most ``BLOCK_BYTES`` of text, one after another over the same rows, so neither the
driver nor a task holds more than one block of it.

Words are lower-cased (A-Z) runs of ASCII letters and digits and non-ASCII bytes, compared by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telequal.llm import text as tx

WINDOW = 10
BLOCK_BYTES = 8 << 20
FOUND = "n_words long, longest long, spans array<struct<start: long, end: long>>, items array<string>"


class Suffixes:
    """All searched suffixes of one benchmark block: each cut at ``window`` words, equal ones once."""

    def __init__(self, ids: list[str], texts: list[bytes], window: int) -> None:
        block = tx.Block(pa.RecordBatch.from_arrays([pa.array(ids)], names=["id"]), texts)
        first, last, row = block.words(tx.ALNUM)
        words = block.hashes(first, last)
        at = tx.offsets(row, len(ids))
        size = np.diff(at)
        per = np.where(size >= window, size - window + 1, np.minimum(size, 1))
        start, owner = tx.expand(at[:-1], per)
        length = np.minimum(size[owner], window)
        keys = np.zeros((len(start), window), np.uint64)
        for t in range(window):
            inside = t < length
            keys[inside, t] = words[start[inside] + t]
        self.ids = np.array(ids, dtype=object)
        self.keys, which = np.unique(keys, axis=0, return_inverse=True)
        order = np.argsort(which, kind="stable")
        self.length = (self.keys != 0).sum(axis=1)  # a word's hash is not 0 but with a chance of 2^-64
        self.members = tx.offsets(which[order], len(self.keys))
        self.item, self.offset = owner[order], (start - at[owner])[order]
        self.window = window
        two = self.length > 1
        self.pairs = np.unique(_pair(self.keys[two, 0], self.keys[two, 1 % window]))
        self.single = np.unique(self.keys[~two, 0])


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return tx.mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


def _among(x: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(wanted):
        return np.zeros(len(x), bool)
    return wanted[np.minimum(np.searchsorted(wanted, x), len(wanted) - 1)] == x


def suffix_array(words: np.ndarray, stop: np.ndarray, start: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``start`` in the order of the word hashes that follow, up to ``depth`` or the document's end, and these."""
    keys = np.zeros((len(start), depth), np.uint64)
    for t in range(depth):
        inside = start + t < stop
        keys[inside, t] = words[start[inside] + t]
    order = np.lexsort(keys.T[::-1])
    return start[order], keys[order]


def bounds(keys: np.ndarray, wanted: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of every wanted suffix: the range of rows in ``keys`` that begin with it."""

    def search(after: bool) -> np.ndarray:
        low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(keys))
        while (open_ := low < high).any():
            mid = np.minimum((low + high) // 2, len(keys) - 1)
            less, equal = np.zeros(len(wanted), bool), np.ones(len(wanted), bool)
            for t in range(wanted.shape[1]):
                x, counts = keys[mid, t], t < length
                less |= equal & counts & (x < wanted[:, t])
                equal &= ~counts | (x == wanted[:, t])
            less |= equal & after
            low, high = np.where(open_ & less, mid + 1, low), np.where(open_ & ~less, mid, high)
        return low

    return search(False), search(True)


def _runs(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)


def _shard(block: tx.Block, query: Suffixes) -> pa.RecordBatch:
    n, window = len(block), query.window
    first, last, row = block.words(tx.ALNUM)
    words = block.hashes(first, last)
    at = tx.offsets(row, n)
    stop = at[1:][row]
    follow = np.flatnonzero(np.arange(1, len(words) + 1) < stop)
    begins = _among(words, query.single)
    begins[follow] |= _among(_pair(words[follow], words[np.minimum(follow + 1, len(words) - 1)]), query.pairs)
    start = np.flatnonzero(begins)
    sa, keys = suffix_array(words, stop[start], start, window)
    low, high = bounds(keys, query.keys, query.length)
    slot, which = tx.expand(low, high - low)
    place = sa[slot]
    # Words inside an occurrence, as maximal runs.
    delta = np.zeros(len(words) + 1, np.int64)
    np.add.at(delta, place, 1)
    np.add.at(delta, place + query.length[which], -1)
    hit = np.concatenate(([False], np.cumsum(delta[:-1]) > 0, [False]))
    cut = np.zeros(len(words) + 2, bool)
    cut[at + 1] = True
    opens = np.flatnonzero(hit[1:-1] & (~hit[:-2] | cut[1:-1]))
    closes = np.flatnonzero(hit[1:-1] & (~hit[2:] | cut[2:])) + 1
    doc = row[opens] if len(opens) else np.zeros(0, np.int64)
    # Every occurrence with every item that has the window; consecutive ones are one longer match.
    slot, pair = tx.expand(query.members[which], np.diff(query.members)[which])
    item, place, length = query.item[slot], place[pair], query.length[which[pair]]
    diagonal = place - query.offset[slot]
    order = np.lexsort((place, diagonal, item))
    item, place, length, diagonal = item[order], place[order], length[order], diagonal[order]
    begin = np.flatnonzero(
        np.concatenate(([True], (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (place[1:] != place[:-1] + 1)))
    ) if len(item) else np.zeros(0, np.int64)
    run = np.diff(np.append(begin, len(item))) - 1 + (length[begin] if len(begin) else 0)
    longest = np.zeros(n, np.int64)
    if len(begin):
        np.maximum.at(longest, row[place[begin]], run)
    found = np.unique(row[place] * max(1, len(query.ids)) + item) if len(item) else np.zeros(0, np.int64)
    owner, name = found // max(1, len(query.ids)), query.ids[found % max(1, len(query.ids))]
    return tx.with_columns(
        block.batch,
        n_words=pa.array(np.diff(at)),
        longest=pa.array(longest),
        spans=tx.lists(
            pa.StructArray.from_arrays([pa.array(opens - at[doc]), pa.array(closes - at[doc])], names=["start", "end"]),
            np.bincount(doc, minlength=n),
        ),
        items=tx.lists(pa.array(name.tolist(), pa.string()), np.bincount(owner, minlength=n)),
    )


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    carry: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``n_words``, ``longest`` (words of the longest verbatim match), ``spans`` of words inside a
    match of at least ``window`` words (or of a whole shorter item), and ``items`` they are from, as strings.

    A null or empty text has no words and no match; so does a null or empty item.  An item without id is reported
    as the empty string; items that share an id are reported once.  Rows repeat as they come; an empty table gives an empty
    result.  Columns of ``docs`` with the names of the added ones are replaced, all others (or those in ``carry``)
    pass through.
    """
    bench = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.coalesce("text", F.lit("")).alias("text")
    )
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(size / block_bytes))
    added = T.StructType.fromDDL(FOUND)
    carry = [c for c in (docs.columns if carry is None else carry) if c not in added.names]
    out = docs.select(*dict.fromkeys([*carry, "text"]))
    for k in range(count):
        part = bench.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k).toArrow()
        query = docs.sparkSession.sparkContext.broadcast(
            (part.column("id").to_pylist(), part.column("text").cast(pa.large_binary()).to_pylist())
        )

        if k:
            out = out.drop("n_words").withColumnsRenamed({c: f"_{c}" for c in ("longest", "spans", "items")})
        keep = [f for f in out.schema.fields if f.name in carry or f.name != "text" or k < count - 1]
        schema = T.StructType([*keep, *added.fields])

        def run(batches, query=query, names=schema.names):
            suffixes = Suffixes(*query.value, window)
            for block in tx.blocks(batches, size=2 * tx.BLOCK_BYTES):
                yield _shard(block, suffixes).select(names)

        out = out.mapInArrow(run, schema)
        if k:
            out = out.withColumns(
                {
                    "longest": F.greatest("longest", "_longest"),
                    "spans": _merged(F.concat("spans", "_spans")),
                    "items": F.concat("items", "_items"),
                }
            ).drop("_longest", "_spans", "_items")
    # Items that share an id are one, in whatever blocks of the benchmark they are.
    return out.withColumn("items", F.array_distinct("items")).select(*carry, *added.names)


def _merged(spans):
    """Sorted spans with those that overlap or touch made one."""
    empty = F.array().cast("array<struct<start: long, end: long>>")
    return F.aggregate(
        F.array_sort(spans),
        empty,
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )


def hit_words(spans: str = "spans"):
    """Words inside the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without those that hold a benchmark passage of ``window`` words or a whole shorter item."""
    found = search(docs, benchmark, window)
    return found.where(F.size("spans") == 0).select(*docs.columns)
