"""Repeated passages by suffix order and longest-previous-factor arrays.

A match is a string of ``length`` bytes that starts in two places, of one document or two.  Suffixes that can match
are brought together by content: in every window of ``length`` bytes the smallest hash of a string of ``gram_bytes`` is
its anchor, so equal windows have equal anchors at equal distances.  The windows of one anchor form a segment.
Two lengths can be asked for at once: anchors are then those of the shorter windows, and a segment's text goes on to the
end of its last longer window, or of the document.

1. Anchors are counted over the corpus; those that occur once cannot match and go no further.
2. Equal segments are one class, with the number of its copies and its first place.  A class of several copies is
   repeated throughout, whatever its size.
3. Where an anchor has different segments, the text of one segment per class is sorted: a suffix order by prefix
   doubling, and from it, by previous and next smaller positions, the longest previous factor of every suffix.  Windows
   with a factor of ``length`` bytes match, and so do, where no copy is kept, those that they repeat.  Every window holds
   the half of its length to the left of the anchor or that to the right, so classes that share neither with another
   class of the anchor are not sorted.
4. An anchor with more than ``LARGE_GROUP`` classes (a passage between many different texts) is not gathered: its
   windows are counted by their hashes, with partial sums before the shuffle.
5. Matches go back to all copies, and documents are cut.

Positions are ordered by document id, then by place; the first copy is the smallest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telequal.llm import text as tx
from telequal.session import durable

LENGTH = 400
#: Bytes of a passage of over fifty words: on sf0.1, 2 % of the runs of 51 words have under 254.
PASSAGE = 256
GRAM = 32
#: A window chooses its anchor from so many strings at most, else these are longer (128 bytes in windows of 400), so
#: that few places share an anchor without sharing a window.
CHOICES = 273
#: Classes of one anchor that are sorted in one task, about 3 MB of text.
LARGE_GROUP = 4096
#: Text held, and text sorted at once, by whole anchors; up to 65,535 bytes three ranks and a position fit 64 bits.
_HELD_BYTES = 1 << 20
_SORT_BYTES = 60_000
#: ``n`` windows, of which the first ``m`` are also windows of the longer length.
SEGMENT = ["anchor", "seg", "off", "n", "m"]
SEGMENT_TYPES = "anchor long, seg long, off int, n int, m int"


def gram_bytes(length: int) -> int:
    """Bytes of the strings that anchors are chosen from."""
    return max(min(GRAM, length), length - CHOICES + 1)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(block: tx.Block, length: int, longer: int = 0) -> dict[str, np.ndarray]:
    """Segments of all texts: row, first window, numbers of windows of either length, the anchor's distance, the hashes
    of the anchor and the text, and those of the halves beside the anchor (of 32 bits; ``-1`` if no window holds it)."""
    gram, longer = gram_bytes(length), max(length, longer)
    size = len(block.data)
    none = {k: np.zeros(0, np.int64) for k in ("row", "at", "n", "m", "off", "anchor", "seg", "left", "right")}
    if size < length:
        return none
    starts = np.arange(size - gram + 1)
    grams = block.hashes(starts, starts + gram)
    key = (grams & ~np.uint64((1 << 26) - 1)) | (starts.astype(np.uint64) & np.uint64((1 << 26) - 1))
    least = window_minima(key, length - gram + 1)
    # Blocks longer than 2^26 hold one document; positions are then completed from the window they lie in.
    place = (least & np.uint64((1 << 26) - 1)).astype(np.int64)
    window = np.arange(len(least))
    place += (window - place + (1 << 26) - 1) // (1 << 26) * (1 << 26)
    row = np.searchsorted(block.end, window)
    fits = window + length <= block.end[row]
    window, place, row = window[fits], place[fits], row[fits]
    if not len(window):
        return none
    first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (row[1:] != row[:-1]))))
    n = np.diff(np.append(first, len(window)))
    at, place, row = window[first], place[first], row[first]
    last = np.minimum(at + n - 1 + longer, block.end[row])
    half = (length - gram + 1) // 2
    seg, left, right = block.hashes(
        np.concatenate((at, np.maximum(place - half, 0), place)),
        np.concatenate((last, place + gram, np.minimum(place + gram + half, size))),
    ).reshape(3, -1)
    short = lambda x, held: np.where(held, (x >> np.uint64(33)).astype(np.int64), -1)
    return {
        "row": row, "at": at - block.start[row], "n": n, "m": np.clip(last - at - longer + 1, 0, n), "off": place - at,
        "anchor": grams[place].view(np.int64), "seg": seg.view(np.int64),
        "left": short(left, place - at >= half), "right": short(right, place - at - n + 1 <= length - gram - half),
    }


def dense_ranks(key: np.ndarray, bits: int) -> np.ndarray:
    """Rank of each key of so many bits among the distinct ones, from 1."""
    room = max(1, len(key) - 1).bit_length()
    if bits + room > 64:
        return np.unique(key, return_inverse=True)[1].astype(np.uint32) + np.uint32(1)
    both = np.sort((key << np.uint64(room)) | np.arange(len(key), dtype=np.uint64))  # faster than an order of the keys
    key, rank = both >> np.uint64(room), np.empty(len(both), np.uint32)
    rank[(both & np.uint64((1 << room) - 1)).astype(np.int64)] = np.cumsum(np.concatenate(([True], key[1:] != key[:-1])))
    return rank


def prefix_ranks(data: np.ndarray, length: int, stop: int = 0) -> list[tuple[int, np.ndarray]]:
    """(width, rank of every position by that many bytes) up to ``length``, with ``stop`` among the widths; past the end
    stand zeros.  Each width joins two ranks of the one before, or as many as fit 64 bits with a position."""
    n, pad = len(data), np.zeros(2 * length + 8, np.uint64)
    room, bits = max(1, n - 1).bit_length(), int(n).bit_length()
    joined = max(2, (64 - room) // bits)
    wide = min((64 - room) // 8, stop or length, length)
    value = np.concatenate((data.astype(np.uint64), pad))
    out = []
    for width in (1, 2, 4):
        if width < wide:
            out.append((width, value.astype(np.uint32)))
        value = (value[: len(value) - width] << np.uint64(8 * width)) | value[width:]
    key, size = value[:n] >> np.uint64(64 - 8 * wide), 8 * wide
    while True:
        rank = np.concatenate((dense_ranks(key, size), pad.astype(np.uint32)))
        out.append((wide, rank))
        if wide >= length:
            return out
        width, wide = wide, min(joined * wide, stop if wide < stop else length)
        key, size = rank[:n].astype(np.uint64), bits
        for at in [*range(width, wide - width, width), wide - width]:
            key, size = (key << np.uint64(bits)) | rank[at : at + n], size + bits


def common_prefix(ranks: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal bytes from positions ``a`` and ``b`` on, up to the largest width ranked."""
    top = ranks[-1][0]
    full = ranks[-1][1][a] == ranks[-1][1][b]
    n = np.zeros(len(a), np.int64)
    for (width, rank), (above, _) in zip(ranks[-2::-1], ranks[:0:-1]):
        for _ in range((above - 1) // width):
            n += np.where(rank[a + n] == rank[b + n], width, 0)
    return np.where(full, top, np.minimum(n, top))


def smaller_before(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value to the left, -1 if there is none."""
    near = np.arange(-1, len(values) - 1)
    todo = np.arange(len(values))
    while len(todo := todo[(near[todo] >= 0) & (values[near[todo]] > values[todo])]):
        near[todo] = near[near[todo]]
    return near


def longest_previous_factor(ranks, start: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For suffixes at ``start``, with distinct places ``order``: the longest prefix that an earlier place also has.

    In suffix order the nearest suffixes of smaller place on either side share the longest prefixes."""
    by = np.lexsort((order, ranks[-1][1][start]))
    place, at = order[by], start[by]
    out = np.zeros(len(start), np.int64)
    left = smaller_before(place)
    right = len(place) - 1 - smaller_before(place[::-1])[::-1]
    for near, there in ((left, left >= 0), (right, right < len(place))):
        i = np.flatnonzero(there)
        out[i] = np.maximum(out[i], common_prefix(ranks, at[i], at[near[i]]))
    back = np.empty_like(out)
    back[by] = out
    return back


def _flag_runs(flag: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of set flags that do not cross the starts in ``first``: begin, end, and whose run each is."""
    cut = np.zeros(len(flag), bool)
    cut[first] = True
    opens = np.flatnonzero(flag & (np.concatenate(([True], ~flag[:-1])) | cut))
    closes = np.flatnonzero(flag & (np.concatenate((~flag[1:], [True])) | np.concatenate((cut[1:], [True])))) + 1
    return opens, closes, np.searchsorted(first, opens, side="right") - 1


def _counts(table: pa.RecordBatch, length: int, longer: int) -> list[tuple[int, np.ndarray]]:
    """Each length asked for, with the number of its windows in every segment."""
    column = lambda c: table.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
    return [(length, column("n")), *([(longer, column("m"))] if longer > length else [])]


def _sorted_groups(length: int, longer: int, keep_first: bool):
    """Task function: segments of different classes of an anchor, anchors together and in order."""

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("bytes").to_pylist()
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(size) - size
        data = np.frombuffer(b"".join(texts), np.uint8)
        ranks = prefix_ranks(data, longer, length)
        ids, uids, at = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("first_doc", "first_uid", "first_at"))
        by, parts = np.lexsort((at, uids, ids)), []  # windows of one document lie in one segment each
        for width, count in _counts(batch, length, longer):
            windows, owner = tx.expand(begin, count)
            before = np.empty(len(by), np.int64)
            before[by] = np.cumsum(count[by]) - count[by]
            order = before[owner] + windows - begin[owner]
            upto = [x for x in ranks if x[0] <= width]
            alike = upto[-1][1][windows]
            twice = np.flatnonzero((np.bincount(alike) > 1)[alike])  # no other window has a factor of its whole length
            flag = np.zeros(len(windows), bool)
            flag[twice] = longest_previous_factor(upto, windows[twice], order[twice]) >= width
            if not keep_first:
                again = np.zeros(len(data) + 2, bool)
                again[alike[flag]] = True
                flag = again[alike]
            some = np.flatnonzero(count)
            first = (np.cumsum(count) - count)[some]
            opens, closes, whose = _flag_runs(flag, first)
            parts.append((np.full(len(opens), width), some[whose], opens - first[whose], closes - first[whose]))
        width, whose, s, e = (np.concatenate(x) for x in zip(*parts))
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(pa.array(whose)) for c in SEGMENT], pa.array(width, pa.int32()), pa.array(s), pa.array(e)],
            names=[*SEGMENT, "width", "s", "e"],
        )

    def run(batches):
        held: pa.Table | None = None
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.column("bytes").nbytes < _HELD_BYTES:
                continue
            key = held.column("anchor").to_numpy()
            cut = len(key) - np.searchsorted(key[::-1] != key[-1], True) if (key != key[-1]).any() else 0
            if cut:
                yield from ready(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None:
            yield from ready(held)

    def ready(table: pa.Table):
        table = table.combine_chunks()
        name = np.stack([table.column(c).to_numpy().astype(np.int64) for c in SEGMENT])
        new = np.concatenate(([True], (name[:, 1:] != name[:, :-1]).any(axis=0)))  # rows that repeat come twice
        table = table.filter(pa.array(new)).combine_chunks()
        key = table.column("anchor").to_numpy()
        size = np.fromiter((len(x) for x in table.column("bytes").to_pylist()), np.int64, len(key))
        edge = np.append(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))), len(key))
        groups = np.add.reduceat(size, edge[:-1])
        for a, b in tx.slices(groups, _SORT_BYTES):
            yield judge(table.slice(edge[a], edge[b] - edge[a]).combine_chunks().to_batches()[0])

    return run


def _segments(docs: DataFrame, length: int, longer: int) -> DataFrame:
    names = ["at", *SEGMENT, "left", "right"]

    def run(batches):
        for block in tx.blocks(batches, lower=False):
            x = anchors(block, length, longer)
            row = pa.array(x["row"])
            yield pa.RecordBatch.from_arrays(
                [block.batch.column("doc_id").take(row), block.batch.column("uid").take(row)]
                + [pa.array(x[c], pa.int64() if c in ("anchor", "seg") else pa.int32()) for c in names],
                names=["doc_id", "uid", *names],
            )

    return docs.mapInArrow(run, f"doc_id long, uid long, at int, {SEGMENT_TYPES}, left int, right int")


def _window_hashes(length: int, longer: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("bytes").to_pylist()
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            for a, b in tx.slices(sizes, tx.BLOCK_BYTES // 4):
                part = batch.slice(a, b - a)
                block = tx.Block(part, texts[a:b], lower=False)
                for width, count in _counts(part, length, longer):
                    window, owner = tx.expand(block.start, count)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[part.column(c).take(pa.array(owner)) for c in [*SEGMENT, "first_doc", "first_uid", "first_at"]],
                            pa.array(np.full(len(window), width), pa.int32()),
                            pa.array(window - block.start[owner], pa.int32()),
                            pa.array(block.hashes(window, window + width).view(np.int64)),
                        ],
                        names=[*SEGMENT, "first_doc", "first_uid", "first_at", "width", "j", "hash"],
                    )

    return run


def matches(docs: DataFrame, length: int = LENGTH, keep_first: bool = False, passage: int | None = None) -> DataFrame:
    """Windows that match, per document: ``doc_id``, ``uid`` and ``spans`` (byte ranges, some overlapping).

    ``docs`` has ``doc_id``, ``text`` and ``uid``.  With ``keep_first`` only windows with an earlier match.  The spans
    in ``passages`` are those of ``passage`` bytes, a shorter length (none: the same spans).
    """
    longer, length = length, min(length, passage or length)
    found = durable(_segments(docs.select("doc_id", "text", "uid"), length, longer))
    heads = found.groupBy("anchor").agg(
        F.count("*").alias("places"), (F.min("seg") != F.max("seg")).alias("differ")
    ).where("places > 1")
    shared = durable(found.join(heads.drop("places"), "anchor"))
    place = F.struct("doc_id", "uid", "at")
    classes = durable(
        shared.groupBy(*SEGMENT, "differ").agg(
            F.count("*").alias("copies"), F.min(place).alias("first"), F.min("left").alias("left"), F.min("right").alias("right")
        ).select(
            *SEGMENT, "differ", "copies", "left", "right", F.col("first.doc_id").alias("first_doc"), F.col("first.uid").alias("first_uid"),
            F.col("first.at").alias("first_at"),
        )
    )
    several = classes.where("differ")
    sizes = several.groupBy("anchor").agg(F.count("*").alias("n_classes"))
    halves = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("half")) for c in ("left", "right")])
    sides = several.withColumn("side", F.explode(halves)).select("*", "side.name", "side.half").where("half >= 0")
    alike = sides.groupBy("anchor", "name", "half").agg(F.count("*").alias("c")).where("c > 1").select("anchor", "name", "half")
    wanted = sides.join(alike, ["anchor", "name", "half"]).join(sizes, "anchor").groupBy("first_doc", "first_uid").agg(
        F.collect_set(F.struct(*SEGMENT, "first_at", "n_classes")).alias("wanted")
    )

    def cut(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            for a in range(0, len(batch), 64):
                part = batch.slice(a, 64)
                lists = part.column("wanted")
                owner = np.repeat(np.arange(len(part)), np.diff(lists.offsets.to_numpy()))
                flat = lists.flatten()
                at, n = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("first_at", "n"))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[flat.field(c) for c in [*SEGMENT, "first_at", "n_classes"]],
                        *[part.column(c).take(pa.array(owner)) for c in ("first_doc", "first_uid")],
                        pa.array([texts[a + o][x : x + m - 1 + longer] for o, x, m in zip(owner, at, n)], pa.binary()),
                    ],
                    names=[*SEGMENT, "first_at", "n_classes", "first_doc", "first_uid", "bytes"],
                )

    text = docs.select(F.col("doc_id").alias("_doc"), F.col("uid").alias("first_uid"), "text")
    pieces = durable(
        wanted.join(text, "first_uid").where("_doc <=> first_doc").select("first_doc", "first_uid", "wanted", "text").mapInArrow(
            cut,
            f"{SEGMENT_TYPES}, first_at int, n_classes long, first_doc long, first_uid long, bytes binary",
        )
    )
    ordinary = pieces.where(F.col("n_classes") <= LARGE_GROUP)
    runs = ordinary.repartition("anchor").sortWithinPartitions(*SEGMENT).mapInArrow(
        _sorted_groups(length, longer, keep_first), f"{SEGMENT_TYPES}, width int, s long, e long"
    )
    large = pieces.where(F.col("n_classes") > LARGE_GROUP).dropDuplicates(SEGMENT)
    rows = large.mapInArrow(
        _window_hashes(length, longer),
        f"{SEGMENT_TYPES}, first_doc long, first_uid long, first_at int, width int, j int, hash long",
    ).withColumn("at", F.struct("first_doc", "first_uid", (F.col("first_at") + F.col("j")).alias("at")))
    least = [F.min("at").alias("least")] if keep_first else []
    key = ["anchor", "width", "hash"]
    again = rows.join(rows.groupBy(*key).agg(F.count("*").alias("c"), *least).where("c > 1"), key)
    if keep_first:
        again = again.where("at != least")
    runs = runs.union(
        again.select(*SEGMENT, "width", F.col("j").cast("long").alias("s"), (F.col("j") + 1).cast("long").alias("e"))
    )
    places = shared.join(
        runs.groupBy(*SEGMENT).agg(F.collect_list(F.struct("width", "s", "e")).alias("runs")), SEGMENT
    ).select("doc_id", "uid", "at", "runs")
    whole = shared.join(
        classes.where("copies > 1").select(*SEGMENT, "first_doc", "first_uid", "first_at"), SEGMENT
    )
    if keep_first:
        whole = whole.where("NOT (doc_id <=> first_doc AND uid = first_uid AND at = first_at)")
    run = lambda w, n: F.struct(F.lit(w).alias("width"), F.lit(0).cast("long").alias("s"), F.col(n).cast("long").alias("e"))
    runs = [run(length, "n"), *([run(longer, "m")] if longer > length else [])]
    whole = whole.select("doc_id", "uid", "at", F.filter(F.array(*runs), lambda r: r["e"] > 0).alias("runs"))
    spans = F.transform(
        "runs",
        lambda r: F.struct(r["width"].alias("width"), (F.col("at") + r["s"]).alias("s"), (F.col("at") + r["e"] + r["width"] - 1).alias("e")),
    )
    of = lambda w: F.transform(F.filter("all", lambda r: r["width"] == w), lambda r: F.struct(r["s"], r["e"]))
    every = places.union(whole).groupBy("doc_id", "uid").agg(F.flatten(F.collect_list(spans)).alias("all"))
    return every.select("doc_id", "uid", of(longer).alias("spans"), of(length).alias("passages"))


def merged(spans: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of covered bytes of every row: the row, where each begins and where it ends."""
    row = np.repeat(np.arange(len(spans)), spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    flat = spans.flatten()
    s, e = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("s", "e"))
    if not len(row):
        return row, s, e
    by = np.lexsort((s, row))
    row, s, e = row[by], s[by], e[by]
    apart = row * (e.max() + 1)
    reach = np.maximum.accumulate(e + apart) - apart
    first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (s[1:] > reach[:-1]))))
    return row[first], s[first], reach[np.append(first[1:], len(row)) - 1]


def _text(batch: pa.RecordBatch, left: list[bytes]) -> dict[str, pa.Array]:
    known = batch.column("text").is_valid().to_pylist()
    return {"text": pa.array([x.decode("utf-8", "ignore") if k else None for k, x in zip(known, left)], pa.string())}


def cut_repeats(
    docs: DataFrame, length: int = LENGTH, keep_first: bool = True, carry_text: bool = True, passage: int | None = None
) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` and the columns ``n_bytes``, ``n_removed``, ``n_spans`` and
    ``kept_bytes`` (what is left, even where a cut falls inside a character; the text has such bytes dropped).

    With ``keep_first`` the first copy stays, else every copy goes.  With ``passage``, a shorter length, the column
    ``passage_bytes`` counts the bytes covered by strings of that length that are found elsewhere (before, with
    ``keep_first``), cut or not.  A null or empty text, or one of fewer bytes than ``length``, stays as it is (null as
    null, with empty ``kept_bytes``).  Rows of one id and one text are one document for the first copy, and copies of
    each other otherwise.  An empty table gives an empty result.  Columns of ``docs`` named like the added ones are
    replaced.
    """
    docs = docs.withColumn("uid", F.xxhash64("doc_id", "text"))
    spans = matches(docs, length, keep_first, passage).select(F.col("doc_id").alias("_doc"), "uid", "spans", "passages")
    joined = docs.join(spans, (docs["uid"] == spans["uid"]) & docs["doc_id"].eqNullSafe(spans["_doc"]), "left").select(
        *[docs[c] for c in docs.columns if c != "uid"],
        spans["spans"].alias("_spans"),
        *([spans["passages"].alias("_passages")] if passage else []),
    )
    added = ["n_bytes", "n_removed", "n_spans", "kept_bytes", *(["passage_bytes"] if passage else [])]
    names = [c for c in docs.columns if c not in ("uid", *added)]
    names = [c for c in names if c != "text" or carry_text]
    schema = ", ".join(f"`{c}` {joined.schema[c].dataType.simpleString()}" for c in names)

    def run(batches):
        for whole in batches:
            for a in range(0, len(whole), 256):
                batch = whole.slice(a, 256)
                texts = batch.column("text").cast(pa.large_binary()).to_pylist()
                size = np.fromiter((len(t or b"") for t in texts), np.int64, len(texts))
                row, begin, end = merged(batch.column("_spans"))
                left = [t or b"" for t in texts]
                edge = np.flatnonzero(np.concatenate((np.diff(row, prepend=-1) != 0, [True])))
                for x, y in zip(edge[:-1], edge[1:]):
                    t = left[row[x]]
                    keep = zip([0, *end[x:y].tolist()], [*begin[x:y].tolist(), len(t)])
                    left[row[x]] = b"".join([t[s:e] for s, e in keep])
                n_removed = size - np.fromiter(map(len, left), np.int64, len(left))
                wide = {}
                if passage:
                    of, s, e = merged(batch.column("_passages"))
                    covered = np.zeros(len(texts), np.int64)
                    np.add.at(covered, of, e - s)
                    wide["passage_bytes"] = pa.array(covered)
                yield tx.with_columns(
                    batch.select(names),
                    **_text(batch, left) if carry_text else {},
                    n_bytes=pa.array(size),
                    n_removed=pa.array(n_removed),
                    n_spans=pa.array(np.bincount(row, minlength=len(texts)), pa.int64()),
                    kept_bytes=pa.array(left, pa.binary()),
                    **wide,
                )

    more = ", passage_bytes long" if passage else ""
    return joined.mapInArrow(run, f"{schema}, n_bytes long, n_removed long, n_spans long, kept_bytes binary{more}")
