"""Lines that many documents repeat: two Bloom filters find suspects, only suspects are shuffled and counted exactly.

1. Every task puts the line hashes of its documents into two filters, *once* and *twice*: a hash that *once* holds
   already goes into *twice* too.  A line counts once per document.  The filters of the tasks are merged piece by
   piece; what two tasks have both seen once joins *twice*, so no repeat is missed.
2. The merged *twice* filter is sent to all tasks.  Its size follows the data up to ``MOST_BITS`` and never beyond.
   Lines that it holds are suspects; they are combined in the task and counted by a 128-bit hash of the whole key.
   A full filter suspects more lines, up to all of them: more is shuffled, the result is the same.
3. Lines confirmed as repeats are cut.  Few of them (``SENT_KEYS``) are sent to the tasks; more are joined back to
   their documents, the most frequent ones without a shuffle of theirs.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telequal.llm import text as tx
from telequal.session import durable, shuffle_width

#: Bits of a filter: as many per expected line of ``LINE_BYTES`` stored bytes, and the least and most.
BITS_PER_LINE = 8
LINE_BYTES = 40
LEAST_BITS, MOST_BITS = 1 << 18, 1 << 29
#: Bytes of the pieces in which filters travel to be merged.
PIECE = 1 << 16
#: Most repeated keys (16 bytes each) that are sent to every task.
SENT_KEYS = 1_000_000
#: A key is joined without a shuffle if it makes up this share of all suspects; there are at most 1 / share such keys.
HOT_SHARE = 1e-4

KEY = "a long, b long"


class Lines:
    """The lines of a block: row, bounds and key of each; a key is the line without white space at both ends, lower-case."""

    def __init__(self, block: tx.Block) -> None:
        raw = block.data
        self.block = block
        self.last = np.sort(np.concatenate((np.flatnonzero(raw == 0x0A), block.end)))
        self.first = np.concatenate(([0], self.last[:-1] + 1))
        self.row = np.searchsorted(block.end, self.last)
        ink = np.flatnonzero(tx.SPACED[raw])
        i, j = np.searchsorted(ink, self.first), np.searchsorted(ink, self.last)
        self.filled = j > i
        ink = np.append(ink, 0)
        self.key_first = np.where(self.filled, ink[np.minimum(i, len(ink) - 1)], self.first)
        self.key_last = np.where(self.filled, ink[j - 1] + 1, self.first)
        block.data = tx.LOWER[raw]
        self.hash = block.hashes(self.key_first, self.key_last)
        self.number = np.arange(len(self.row)) - tx.offsets(self.row, len(block))[self.row]

    def long_enough(self, min_chars: int) -> np.ndarray:
        """Indices of the lines whose keys have enough code points."""
        starts = np.concatenate(([0], np.cumsum((self.block.data & 0xC0) != 0x80)))
        return np.flatnonzero(self.filled & (starts[self.key_last] - starts[self.key_first] >= min_chars))

    def counted(self, min_chars: int) -> np.ndarray:
        """Of these, the first line of each key in each document."""
        at = self.long_enough(min_chars)
        order = at[np.lexsort((self.number[at], self.hash[at], self.row[at]))]
        new = np.ones(len(order), bool)
        new[1:] = (self.row[order[1:]] != self.row[order[:-1]]) | (self.hash[order[1:]] != self.hash[order[:-1]])
        return order[new]

    def digest(self, i: int) -> int:
        """A second, unrelated hash of the whole key."""
        key = self.block.data[self.key_first[i] : self.key_last[i]].tobytes()
        return int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little", signed=True)

    def digests(self, at: np.ndarray) -> np.ndarray:
        return np.fromiter((self.digest(i) for i in at.tolist()), np.int64, len(at))


class Filter:
    """Bits of a Bloom filter; a hash sets ``probes`` of them."""

    def __init__(self, bits: int, probes: int, data: np.ndarray | None = None) -> None:
        self.size, self.probes = bits, probes
        self.bytes = np.zeros(bits >> 3, np.uint8) if data is None else data

    def places(self, hashes: np.ndarray):
        step = tx.mix(hashes + np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)
        for k in range(self.probes):
            yield ((hashes + np.uint64(k) * step) >> np.uint64(20)).astype(np.int64) & (self.size - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in self.places(hashes):
            found &= (self.bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return found

    def add(self, hashes: np.ndarray) -> None:
        for at in self.places(hashes):
            for bit in range(8):
                self.bytes[at[at & 7 == bit] >> 3] |= np.uint8(1 << bit)


def _line_blocks(batches):
    for block in tx.blocks(batches, lower=False):
        yield block, Lines(block)


def _sketched(bits: int, probes: int, min_chars: int):
    """The pieces of both filters of one task that hold anything."""

    def run(batches):
        once, twice = Filter(bits, probes), Filter(bits, probes)
        for _, lines in _line_blocks(batches):
            hashes, n = np.unique(lines.hash[lines.counted(min_chars)], return_counts=True)
            twice.add(hashes[(n > 1) | once.holds(hashes)])
            once.add(hashes)
        for p in range(0, len(once.bytes), PIECE):
            a = once.bytes[p : p + PIECE]
            if a.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p // PIECE], pa.int32())]
                    + [pa.array([zlib.compress(x, 1)], pa.binary()) for x in (a, twice.bytes[p : p + PIECE])],
                    names=["piece", "once", "twice"],
                )

    return run


def _merged(batches):
    """The *twice* bits of each piece; pieces of one number follow each other."""
    at, once, twice = None, None, None

    def done():
        return pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int32()), pa.array([zlib.compress(twice, 1)], pa.binary())], names=["piece", "twice"]
        )

    for batch in batches:
        for piece, a, b in zip(batch.column("piece").to_pylist(), batch.column("once"), batch.column("twice")):
            a, b = (np.frombuffer(zlib.decompress(x.as_py()), np.uint8) for x in (a, b))
            if piece != at:
                if at is not None:
                    yield done()
                at, once, twice = piece, np.zeros_like(a), np.zeros_like(b)
            twice |= b | (once & a)
            once |= a
    if at is not None:
        yield done()


def seen_twice(docs: DataFrame, min_chars: int = 1, bits: int | None = None) -> Filter:
    """The *twice* filter of all lines of ``docs``: every key of two documents or more is in it, few others are.

    At most ``MOST_BITS`` bits reach the driver, however large the table is.
    """
    stored = int(docs.select("text")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    expected = max(1, stored // LINE_BYTES)
    bits = bits or min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_LINE * expected - 1).bit_length()))
    probes = int(np.clip(bits // (2 * expected), 1, 4))
    pieces = docs.select("text").mapInArrow(
        _sketched(bits, probes, min_chars), "piece int, once binary, twice binary"
    )
    found = Filter(bits, probes)
    width = max(1, min(shuffle_width(docs.sparkSession), (bits >> 3) // PIECE))
    merged = pieces.repartition(width, "piece").sortWithinPartitions("piece").mapInArrow(_merged, "piece int, twice binary")
    for row in merged.toLocalIterator():
        part = np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
        found.bytes[row["piece"] * PIECE :][: len(part)] = part
    return found


def _shared(spark, twice: Filter):
    """What tasks need of a filter, as plain values."""
    return spark.sparkContext.broadcast((twice.size, twice.probes, twice.bytes))


def _suspected_keys(shared, min_chars: int):
    """Suspected keys of the documents of a block: documents and first place of each."""
    end = np.iinfo(np.int64).max

    def run(batches):
        twice = Filter(*shared.value)
        for block, lines in _line_blocks(batches):
            at = lines.counted(min_chars)
            at = at[twice.holds(lines.hash[at])]
            ids = block.batch.column("doc_id").take(pa.array(lines.row[at]))
            no_id = ids.is_null().to_numpy(zero_copy_only=False)
            doc = ids.fill_null(end).to_numpy(zero_copy_only=False)
            a, b, line = lines.hash[at].view(np.int64), lines.digests(at), lines.number[at]
            order = np.lexsort((line, doc, no_id, b, a))
            new = np.ones(len(order), bool)
            new[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
            head = np.flatnonzero(new)
            first = order[head]
            columns = {"a": a[first], "b": b[first], "n": np.diff(np.append(head, len(order))), "no_id": no_id[first]}
            columns |= {"doc": doc[first], "line": line[first]}
            yield pa.RecordBatch.from_pydict({c: pa.array(v) for c, v in columns.items()})

    return run


def _suspected_lines(shared, min_chars: int):
    """Every suspected line of every document."""

    def run(batches):
        twice = Filter(*shared.value)
        for block, lines in _line_blocks(batches):
            at = lines.long_enough(min_chars)
            at = at[twice.holds(lines.hash[at])]
            row = pa.array(lines.row[at])
            columns = {c: block.batch.column(c).take(row) for c in ("doc_id", "_uid")}
            columns |= {"line": pa.array(lines.number[at]), "a": pa.array(lines.hash[at].view(np.int64))}
            yield pa.RecordBatch.from_pydict(columns | {"b": pa.array(lines.digests(at))})

    return run


def repeated_keys(
    docs: DataFrame, min_documents: int = 2, min_chars: int = 1, twice: Filter | None = None
) -> DataFrame:
    """(a, b, n, first): the 128-bit hashes of keys in at least ``min_documents`` documents, how many these are, and the
    first place (no_id, doc, line) by ``doc_id``, null ones last.  Suspects alone are shuffled, combined in the tasks.
    """
    twice = twice or seen_twice(docs, min_chars)
    shared = _shared(docs.sparkSession, twice)
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _suspected_keys(shared, min_chars), f"{KEY}, n long, no_id boolean, doc long, line long"
    )
    return (
        found.groupBy("a", "b")
        .agg(F.sum("n").alias("n"), F.min(F.struct("no_id", "doc", "line")).alias("first"))
        .where(F.col("n") >= min_documents)
    )


def _cut(names: list[str], keep_first: bool, few=None, gone_in: str | None = None):
    """Drop lines: those whose keys the broadcast ``few`` holds, or those that the column ``gone_in`` lists."""

    def gone(block: tx.Block, lines: Lines) -> list[tuple[int, int]]:
        keys = few.value
        at = np.flatnonzero(lines.filled)
        h = lines.hash[at].view(np.int64)
        place = np.searchsorted(keys["a"], h)
        at = at[(place < len(keys["a"])) & (keys["a"][np.minimum(place, len(keys["a"]) - 1)] == h)] if len(keys["a"]) else at[:0]
        ids = block.batch.column("doc_id").to_pylist() if keep_first else None
        out = []
        for i in at.tolist():
            first = keys["first"].get((int(lines.hash[i].view(np.int64)), lines.digest(i)))
            if first is None:
                continue
            if keep_first:
                doc = ids[lines.row[i]]
                if first == (doc is None, np.iinfo(np.int64).max if doc is None else doc, int(lines.number[i])):
                    continue
            out.append((int(lines.row[i]), int(lines.number[i])))
        return out

    def run(batches):
        for block in tx.blocks(batches, lower=False):
            texts = block.batch.column("text").to_pylist()
            n_lines = np.ones(len(block), np.int64)
            np.add.at(n_lines, np.searchsorted(block.end, np.flatnonzero(block.data == 0x0A)), 1)
            drop: dict[int, set[int]] = {}
            if few is None:
                for r, x in enumerate(block.batch.column(gone_in).to_pylist()):
                    if x:
                        drop[r] = set(x)
            else:
                for r, number in gone(block, Lines(block)):
                    drop.setdefault(r, set()).add(number)
            for r, numbers in drop.items():
                texts[r] = "\n".join(x for k, x in enumerate(texts[r].split("\n")) if k not in numbers)
            n_dropped = [len(drop.get(r, ())) for r in range(len(texts))]
            yield tx.with_columns(
                block.batch.select(names),
                text=pa.array(texts, pa.string()),
                n_lines=pa.array(n_lines),
                n_dropped=pa.array(n_dropped, pa.int64()),
            )

    return run


def drop_repeated_lines(
    docs: DataFrame,
    min_documents: int = 2,
    min_chars: int = 1,
    keep_first: bool = True,
    sent_keys: int = SENT_KEYS,
    bits: int | None = None,
) -> DataFrame:
    """``docs`` without the lines whose key is in ``min_documents`` documents or more; adds ``n_lines`` and ``n_dropped``.

    A key is a line without white space at both ends, A-Z in lower case; lines whose keys have fewer than ``min_chars``
    code points stay.  With ``keep_first`` the first place of each key stays, that of the smallest ``doc_id`` (null last)
    and line; rows that share an id and have the key in that line all keep it.  A null text stays null and an empty one
    empty, both with one line; every row is a document, so repeated rows are repeats of each other.  Columns ``n_lines``
    and ``n_dropped`` of ``docs`` are replaced, all others stay.  An empty table gives an empty result.
    """
    twice = seen_twice(docs, min_chars, bits)
    keys = durable(repeated_keys(docs, min_documents, min_chars, twice))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    kept = docs.select(*[f"`{c}`" for c in names])
    schema = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in names) + ", n_lines long, n_dropped long"
    total, n_keys = keys.agg(F.sum("n"), F.count("*")).first()
    sc = docs.sparkSession.sparkContext
    if n_keys <= sent_keys:
        rows = keys.orderBy("a").toArrow()
        a, b, first = (rows.column(c).to_pylist() for c in ("a", "b", "first"))
        places = [(x["no_id"], x["doc"], x["line"]) for x in first]
        few = sc.broadcast({"a": np.array(a, np.int64), "first": dict(zip(zip(a, b), places))})
        return kept.mapInArrow(_cut(names, keep_first, few), schema)
    uid = F.xxhash64("doc_id", "text")
    each = docs.select(F.col("doc_id").cast("long"), "text", uid.alias("_uid")).mapInArrow(
        _suspected_lines(_shared(docs.sparkSession, twice), min_chars), f"doc_id long, _uid long, line long, {KEY}"
    )
    hot = F.col("n") > F.lit(total * HOT_SHARE)
    pairs = durable(each)
    judged = pairs.join(F.broadcast(keys.where(hot)), ["a", "b"]).unionByName(pairs.join(keys.where(~hot), ["a", "b"]))
    if keep_first:
        here = (F.col("first.no_id") == F.col("doc_id").isNull()) & (F.col("first.line") == F.col("line"))
        judged = judged.where(~(here & (F.col("first.no_id") | F.coalesce(F.col("first.doc") == F.col("doc_id"), F.lit(False)))))
    gone = judged.groupBy(F.col("doc_id").alias("_doc"), "_uid").agg(  # bounded by the lines of a document
        F.collect_set("line").alias("_lines")
    )
    gone_in = "_gone" + "_" * max(map(len, names))  # longer than any column of the table
    there = (uid == gone["_uid"]) & F.col("doc_id").cast("long").eqNullSafe(gone["_doc"])
    joined = kept.join(gone, there, "left").select(*[kept[f"`{c}`"] for c in names], gone["_lines"].alias(gone_in))
    return joined.mapInArrow(_cut(names, keep_first, gone_in=gone_in), schema)
