"""Near-duplicate classes by HyperMinHash sketches, banding, estimation and verification.

1. Every text becomes a set of word shingles, as 64-bit hashes, and a sketch: ``REGISTERS`` buckets by the top hash
   bits, each holding the smallest remaining hash as 6 bits of leading zeros and 10 of mantissa.
2. Texts with equal sets are one class, represented by its smallest id; only representatives go on.
3. Bands of consecutive registers are hashed to keys.  Bands and rows follow from the similarity so that a pair at
   the limit is missed with a probability of 1e-7 at most; more similar pairs are missed far less.
4. Every representative meets the smallest id under each of its keys.  Pairs pass a size test, the collision-corrected
   estimate with a margin of six standard errors, and then the exact test on the full sets.
5. Keys whose members then still lie in different components are looked at again, so that no link between members of
   two components is lost: small ones pair by pair; the documents of large ones (texts that share a passage but little
   else, families of texts around the limit) get new keys, the rarest shingles of each with a class of set sizes.
   Order all shingles by rarity.  The first shingle that two similar sets share is the i-th of one and the j-th of the
   other, and no more can follow than the rest of either, so both places are low; a text is listed under the shingles
   whose places allow partners of its own size or more, and asks under those that allow smaller ones, for these sizes
   only.  Sets that share common shingles alone, each behind many rare ones of its own, do not meet.  No link is lost.
   Pairs within a component are never compared, and the largest component of a key is not met with itself.

A copy group of any size costs one comparison per member and band key, and no step gathers a group in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telequal.llm import text as tx
from telequal.llm.components import components
from telequal.session import broadcast_if_small, durable

REGISTERS = 512
_BUCKET_BITS = 9
_REST = 64 - _BUCKET_BITS
MANTISSA_BITS = 10
MISS = 1e-7
#: A key with more members, of several components, is large.
LARGE_KEY = 24
#: Bins in which shingles of the documents of large keys are counted, to tell rare ones.
RARITY_BINS = 1 << 20
#: Ratio between the classes of set sizes.
SIZE_STEP = 1.04
#: Bytes of Arrow batches that hold whole texts of pairs.
PAIR_BYTES = 8 << 20
#: Most ids sent to a scan.
MOST_SENT = 1_000_000


def bands_for(similarity: float) -> tuple[int, int]:
    """Bands and rows: as many rows as the miss bound allows."""
    for rows in range(16, 1, -1):
        bands = REGISTERS // rows
        if (1 - similarity**rows) ** bands <= MISS:
            return bands, rows
    return REGISTERS, 1


def band_registers(similarity: float) -> np.ndarray:
    """The registers of each band."""
    bands, rows = bands_for(similarity)
    return np.arange(bands * rows).reshape(bands, rows)


def shingles(block: tx.Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within it, and each one's text.  A text of fewer words is one
    shingle; one without words has none."""
    first, last, row = block.words(tx.SPACED)
    words = block.hashes(first, last)
    at = tx.offsets(row, len(block))
    size = np.diff(at)
    grams = tx.sequence_hash(words, width)
    whole = np.flatnonzero(row[: len(grams)] == row[width - 1 : width - 1 + len(grams)])
    gram, owner = grams[whole], row[whole]
    for n in range(1, width):
        short = np.flatnonzero(size == n)
        if len(short):
            h = np.full(len(short), n, np.uint64)
            for j in range(n):
                h = h * np.uint64(0xD6E8FEB86659FD93) + words[at[short] + j]
            gram, owner = np.concatenate((gram, tx.mix(h))), np.concatenate((owner, short))
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    return gram[new], owner[new]


def registers(gram: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sketch of each of ``n`` texts; an empty bucket is 0."""
    bucket = (gram >> np.uint64(_REST)).astype(np.int64)
    cell = owner * REGISTERS + bucket
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    rest = (gram[first] & np.uint64((1 << _REST) - 1)).astype(np.float64)
    mantissa, exponent = np.frexp(np.maximum(rest, 0.5))
    zeros = np.clip(_REST - exponent, 0, 62).astype(np.uint16) + np.uint16(1)
    out = np.zeros(n * REGISTERS, np.uint16)
    out[cell[first]] = (zeros << MANTISSA_BITS) | np.minimum(
        ((mantissa - 0.5) * 2 * (1 << MANTISSA_BITS)).astype(np.uint16), (1 << MANTISSA_BITS) - 1
    )
    return out.reshape(n, REGISTERS)


def densified(regs: np.ndarray) -> np.ndarray:
    """Sketches with every empty register filled from a register that fixed random maps lead to.

    A short text fills few registers, so a band of raw ones could be a single shingle; of these, each register still
    agrees with the probability of the Jaccard similarity, and a band always speaks for several shingles."""
    out, draw = regs.copy(), np.random.default_rng(0)
    for _ in range(64):
        there = draw.integers(0, REGISTERS, REGISTERS)
        empty = out == 0
        if not empty.any():
            return out
        out = np.where(empty, regs[:, there], out)
    first = np.maximum.accumulate(np.where(regs != 0, np.arange(REGISTERS), 0), axis=1)
    return np.where(out == 0, np.where((f := np.take_along_axis(regs, first, 1)) != 0, f, regs.max(axis=1)[:, None]), out)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimate of sketch pairs, less the expected chance collisions, and the buckets it rests on."""
    used = (a != 0) | (b != 0)
    same = ((a == b) & used).sum(axis=1)
    union = np.maximum(used.sum(axis=1), 1)
    large, small = np.maximum(n_a, n_b), np.maximum(np.minimum(n_a, n_b), 1)
    ratio = large / small
    by_chance = 0.169919487159739 * (4 * ratio / (1 + ratio) ** 2) * REGISTERS / (1 << MANTISSA_BITS)
    by_chance = np.minimum(by_chance, 0.01 * union)
    return np.maximum(same - by_chance, 0) / union, union


def _sums(gram: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(gram, dtype=np.uint64)))
    return (total[at[1:]] - total[at[:-1]]).view(np.int64)


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id``, set size, a 128-bit name of the set, and the sketch."""

    def run(batches):
        for block in tx.blocks(batches):
            gram, owner = shingles(block, width)
            at = tx.offsets(owner, len(block))
            regs = registers(gram, owner, len(block))
            yield pa.RecordBatch.from_arrays(
                [
                    block.batch.column("doc_id"),
                    pa.array(np.diff(at)),
                    pa.array(_sums(gram, at)),
                    pa.array(_sums(tx.mix(gram ^ np.uint64(0x5851F42D4C957F2D)), at)),
                    pa.array([r.tobytes() for r in regs], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "k1", "k2", "sketch"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, k1 long, k2 long, sketch binary"
    )


def _band_keys(rows: DataFrame, registers_of: np.ndarray) -> DataFrame:
    """A row (``key``, ``id``) per band."""

    def run(batches):
        bands, width = registers_of.shape
        for whole in batches:
            for a in range(0, len(whole), 512):
                batch = whole.slice(a, 512)
                m = len(batch)
                regs = densified(np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(m, REGISTERS))
                key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(width), (m, bands)).copy()
                for j in range(width):
                    key = tx.mix(key * np.uint64(0xD6E8FEB86659FD93) + regs[:, registers_of[:, j]])
                row = pa.array(np.repeat(np.arange(m), bands))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.ravel().view(np.int64)), batch.column("id").take(row)], names=["key", "id"]
                )

    return rows.mapInArrow(run, "key long, id long").select("key", "id", F.lit(0).alias("role"), F.lit(0).alias("place"))


def _size_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(n, 1)) / np.log(SIZE_STEP)).astype(np.int64)


def _rare_keys(texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """A row (``key``, ``id``, ``role``, ``place``) per rare shingle and class of set sizes.

    ``role`` 1 lists a text under its own size, ``role`` 2 asks for partners of its size or less; ``place`` is the
    shingle's place in the text by rarity.  Any one order of all shingles gives the same links.  Rare first keeps groups
    small, so rarity is counted in ``RARITY_BINS`` bins over all these texts, a table of fixed size.
    """
    p, shift = round(similarity * 100), np.uint64(65 - RARITY_BINS.bit_length())

    def count(batches):
        found = np.zeros(RARITY_BINS, np.int64)
        for block in tx.blocks(batches):
            gram, _ = shingles(block, width)
            found += np.bincount((gram >> shift).astype(np.int64), minlength=RARITY_BINS)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"bin": pa.array(at, pa.int32()), "n": pa.array(found[at])})

    rarity = np.zeros(RARITY_BINS, np.int64)
    counts = texts.select("text").mapInArrow(count, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    rarity[counts.column("bin").to_numpy()] = counts.column("n").to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(rarity)

    def run(batches):
        for block in tx.blocks(batches):
            gram, owner = shingles(block, width)
            order = np.lexsort((gram, shared.value[(gram >> shift).astype(np.int64)], owner))
            gram, owner = gram[order], owner[order]
            at = tx.offsets(owner, len(block))
            size = np.diff(at)[owner]
            place = np.arange(len(owner)) - at[owner]
            left = size - place  # shingles from here on
            # Sets of m and n shingles are similar if they share p / (100 + p) * (m + n).
            listed = np.flatnonzero((100 + p) * left >= 2 * p * size)
            largest = np.minimum(size, (100 + p) * left // p - size)
            least = -(-p * size // 100)
            asks = np.flatnonzero(largest >= least)
            low, high = _size_class(least[asks]), _size_class(largest[asks])
            classes, of = tx.expand(low, high - low + 1)
            entry = np.concatenate((listed, asks[of]))
            of_size = np.concatenate((_size_class(size[listed]), classes))
            key = tx.mix(gram[entry] ^ tx.mix(of_size.astype(np.uint64) + np.uint64(1)))
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array(key.view(np.int64)),
                    "id": block.batch.column("id").take(pa.array(owner[entry])),
                    "role": pa.array(np.repeat([1, 2], [len(listed), len(of)]), pa.int32()),
                    "place": pa.array(place[entry], pa.int32()),
                }
            )

    return texts.select("id", "text").mapInArrow(run, "key long, id long, role int, place int")


def _verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, similarity: float, width: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are similar enough."""

    percent = round(similarity * 100)

    def sift(batches):
        for whole in batches:
            for s in range(0, len(whole), 2048):
                batch = whole.slice(s, 2048)
                m = len(batch)
                if not m:
                    continue
                x, y = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(m, REGISTERS)
                    for c in ("sketch_a", "sketch_b")
                )
                n_a, n_b = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("n_a", "n_b"))
                guess, buckets = estimate(x, y, n_a, n_b)
                margin = 6 * np.sqrt(similarity * (1 - similarity) / buckets)
                fits = np.minimum(n_a, n_b) * 100 >= np.maximum(n_a, n_b) * percent
                yield batch.select(["a", "b"]).filter(pa.array(fits & (guess >= similarity - margin - 0.01)))

    def exact(batches):
        for whole in batches:
            for batch, x, y in _text_pairs(whole):
                n = len(batch)
                (gx, ox), (gy, oy) = shingles(x, width), shingles(y, width)
                size = np.bincount(ox, minlength=n) + np.bincount(oy, minlength=n)
                g, o = np.concatenate((gx, gy)), np.concatenate((ox, oy))
                order = np.lexsort((g, o))
                g, o = g[order], o[order]
                both = np.bincount(o[1:][(g[1:] == g[:-1]) & (o[1:] == o[:-1])], minlength=n)
                yield batch.select(["a", "b"]).filter(pa.array((100 * both >= percent * (size - both)) & (both > 0)))

    side = lambda s: reps.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    likely = durable(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(sift, "a long, b long"))
    # Only texts of likely pairs go on: their ids are sent to the scan if they are few, else the texts meet them in one join.
    ids = broadcast_if_small(likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), MOST_SENT)
    wanted = durable(docs.select(F.col("doc_id").cast("long"), "text").join(ids, "doc_id", "left_semi"))
    text = lambda s: wanted.select(F.col("doc_id").alias(s), F.col("text").alias(f"text_{s}"))
    found = likely.join(text("a"), "a").join(text("b"), "b").mapInArrow(exact, "a long, b long")
    with tx.batches_of(docs.sparkSession, PAIR_BYTES):
        return durable(found.distinct())


def _text_pairs(whole: pa.RecordBatch):
    texts = [whole.column(c).cast(pa.large_binary()).fill_null(b"").to_pylist() for c in ("text_a", "text_b")]
    sizes = np.array([len(p) + len(q) for p, q in zip(*texts)], np.int64)
    for s, e in tx.slices(sizes, 2 * tx.BLOCK_BYTES):
        batch = whole.slice(s, e - s)
        yield batch, tx.Block(batch, texts[0][s:e]), tx.Block(batch, texts[1][s:e])


def classes(docs: DataFrame, width: int = 3, similarity: float = 0.85) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``.

    A null or empty text, or one of blanks, has no shingles and is linked with nothing: it is its own component.
    Rows without an id take part in no link and are kept, with a null component; rows that share an id share the
    component of the smallest of their texts' classes.  An empty table gives an empty result.  Only ``doc_id`` and
    ``text`` are read; other columns are ignored.
    """
    sketches = durable(sketched(docs, width))
    full = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    groups = durable(
        full.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("id"))
    )
    reps = durable(
        full.join(groups, ["k1", "k2", "n_shingles"]).where("doc_id = id")
        .select("id", F.col("n_shingles").alias("n"), "sketch")
        .where(F.col("n") >= int(similarity / (1 - similarity)))  # a smaller set is similar to itself only
    )
    keys, links, n_of = _band_keys(reps, band_registers(similarity)), None, reps.select("id", "n")
    percent = round(similarity * 100)
    for last in (False, True):
        shared = keys.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("lead")).where("size > 1")
        met = durable(keys.join(shared.select("key", "lead"), "key"))
        if links is None:
            star = met.where("id > lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
            links = _verified(star, reps, docs, similarity, width)
        roots = components(links)
        placed = met.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        # Keys of several components, with the largest one of each.
        of_root = placed.groupBy("key", "root").agg(F.count("*").alias("c"))
        mixed = of_root.groupBy("key").agg(F.sum("c").alias("size"), F.count("*").alias("n_roots"), F.max_by("root", "c").alias("top"))
        open_ = durable(placed.join(mixed.where("n_roots > 1 AND size > 2" if not last else "n_roots > 1").select("key", "size", "top"), "key"))
        small = open_ if last else open_.where(F.col("size") <= LARGE_KEY)
        small = durable(small.join(n_of, "id"))
        listed = small.where("role < 2").select(
            "key", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("root").alias("root_a"), F.col("place").alias("i"), "lead", "top"
        )
        asking = small.where("role != 1").select(
            "key", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("root").alias("root_b"), F.col("place").alias("j"),
            F.col("top").alias("top_b"),
        )
        fits = f"{100 + percent} * least(n_a - i, n_b - j) >= {percent} * (n_a + n_b) AND root_a != root_b AND " + (
            "n_a <= n_b" if last else "(n_a < n_b OR n_a = n_b AND a < b) AND a != lead AND b != lead"
        )
        pairs = listed.where("root_a != top").join(asking.drop("top_b"), "key").where(fits).unionByName(
            listed.where("root_a = top").join(asking.where("root_b != top_b").drop("top_b"), "key").where(fits)
        )
        cross = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        links = links.union(_verified(cross, reps, docs, similarity, width))
        large = open_.where(F.col("size") > LARGE_KEY).select("id").distinct()
        if last or large.isEmpty():
            break
        ids = broadcast_if_small(large.select(F.col("id").alias("doc_id")), MOST_SENT)
        texts = docs.select(F.col("doc_id").cast("long"), "text").join(ids, "doc_id", "left_semi")
        keys = _rare_keys(durable(texts.select(F.col("doc_id").alias("id"), "text")), width, similarity)
    roots = components(links)
    ids = groups.join(roots.withColumnRenamed("node", "id"), "id", "left").select(
        "k1", "k2", "n_shingles", F.coalesce("root", "id").alias("component_id")
    )
    return sketches.drop("sketch").join(ids, ["k1", "k2", "n_shingles"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def deduplicated(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each component, the one with the smallest id; the columns of ``docs``."""
    gone = classes(docs, width, similarity).where("NOT kept").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
