"""The prefix trie of rebuilt conversations from fingerprints that compose, without rebuilding any text.

A sequence of turns is the pair (B^n, s): s is the fold s * B + h over the hashes h of its turns, modulo a prime of 127
bits.  Pairs form a monoid: (m1, s1) then (m2, s2) is (m1 * m2, s1 * m2 + s2).  So

* a conversation of any length is folded in pieces, one per sorted partition that it reaches into, and pieces compose;
* the first d turns of a rebuilt conversation, a head of one conversation followed by the rest of another, have a
  fingerprint that follows from the fingerprints of both; only numbers travel, never texts.

Turns are stored once.  Equality of prefixes is not left to the fingerprints: all members of a node must refer to equal
turns, and have equal parents, and all stored turns of one hash must have one text.  Where that fails (it never should)
everything is repeated with other hashes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telequal.operators.ordered import running_totals
from telequal.session import durable, shuffle_width

P = (1 << 127) - 1
#: A conversation is hot, and joined by broadcast, from this many turns and this share of all; at most 1 / share are.
HOT_TURNS, HOT_SHARE = 1_000_000, 1e-4
#: Conversation ids per piece of a list of members: 2 to this power.
PIECE_BITS = 12
#: Hash functions that are tried before giving up.
SEEDS = 4


def _base(seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(b"base", key=bytes([seed]), digest_size=16).digest(), "big") % P | 1


def _bytes(x: int) -> bytes:
    return x.to_bytes(16, "big")


def _number(x: bytes) -> int:
    return int.from_bytes(x, "big")


TURN = "part int, conv_id long, i long, s binary, turn binary, chars long, role string, text string"


def _folded(seed: int):
    """Hash and running fold of every turn of a sorted partition; only the running pair is kept."""
    base, key = _base(seed), bytes([seed])

    def run(batches):
        conv, i, s = None, 0, 0
        for batch in batches:
            out = {c: [] for c in ("i", "s", "turn", "chars")}
            for c, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "role", "text"))):
                if c != conv:
                    conv, i, s = c, 0, 0
                r = role.encode()
                turn = hashlib.blake2b(len(r).to_bytes(8, "big") + r + text.encode(), key=key, digest_size=16).digest()
                i, s = i + 1, (s * base + _number(turn)) % P
                for name, value in zip(out, (i, _bytes(s), turn, len(text))):
                    out[name].append(value)
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in ("part", "conv_id")}
                | {c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds)}
                | {c: batch.column(c) for c in ("role", "text")}
            )

    return run


def _shifted(seed: int):
    """The fold of a later piece of a conversation, after the pieces before it."""
    base = _base(seed)

    def run(batches):
        for batch in batches:
            n, before, i, s = (batch.column(c).to_pylist() for c in ("n0", "s0", "i", "s"))
            moved = [_bytes((_number(y) + _number(x) * pow(base, k, P)) % P) if a else y for a, x, k, y in zip(n, before, i, s)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array([a + k for a, k in zip(n, i)], pa.int64()), pa.array(moved, pa.binary())]
                + [batch.column(c) for c in ("turn", "chars")],
                names=["conv_id", "i", "s", "turn", "chars"],
            )

    return run


def _composed(seed: int):
    """Own turns behind a head: depth, fingerprint and the parent's fingerprint."""
    base = _base(seed)
    back = pow(base, -1, P)

    def run(batches):
        for batch in batches:
            depth, fp, above = [], [], []
            names = ("i", "s", "turn", "h", "k", "head_s", "skipped_s")
            for i, s, turn, h, k, head, skipped in zip(*(batch.column(c).to_pylist() for c in names)):
                x = (_number(s) + (_number(head) - _number(skipped)) * pow(base, i - h, P)) % P
                depth.append(k + i - h)
                fp.append(_bytes(x))
                above.append(_bytes((x - _number(turn)) * back % P))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *[pa.array(depth, pa.int64()), pa.array(fp, pa.binary()), pa.array(above, pa.binary())]]
                + [batch.column(c) for c in ("turn", "chars", "length")],
                names=["conv_id", "depth", "fp", "parent_fp", "turn", "chars", "length"],
            )

    return run


def stored_turns(rows: DataFrame, seed: int) -> DataFrame:
    """All turns, written once: (part, conv_id, i, s, turn, chars, role, text).

    They are ordered by conversation and turn (null first, ties by role and text); null role and text are empty, rows
    without ``conv_id`` are left out.  Parts are ranges, so a long conversation has turns in several; ``i`` and the fold
    ``s`` count from its first turn in the part.
    """
    empty = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]
    turns = rows.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), "turn", *empty)
    place = ["conv_id", F.col("turn").asc_nulls_first()]
    dealt = turns.repartitionByRange(shuffle_width(rows.sparkSession), *place)
    ordered = dealt.sortWithinPartitions(*place, "role", "text").withColumn("part", F.spark_partition_id())
    return durable(ordered.select("part", "conv_id", "role", "text").mapInArrow(_folded(seed), TURN))


def fingerprints(stored: DataFrame, seed: int) -> DataFrame:
    """(conv_id, i, s, turn, chars): the pieces of each conversation composed, ``s`` folding its first ``i`` turns."""
    pieces = stored.select("part", "conv_id", "i", "s", "turn", "chars")
    ends = pieces.groupBy("conv_id", "part").agg(F.max(F.struct("i", "s")).alias("end"))
    several = ends.groupBy("conv_id").count().where("count > 1").select("conv_id")
    # A conversation in several parts crosses a boundary of parts: fewer rows than two for each part.
    crossing = ends.join(several, "conv_id", "left_semi").orderBy("conv_id", "part").collect()
    carried, conv, base = [], None, _base(seed)
    for r in crossing:
        if r["conv_id"] != conv:
            conv, n, s = r["conv_id"], 0, 0
        carried.append((r["part"], conv, n, _bytes(s)))
        n, s = n + r["end"]["i"], (s * pow(base, r["end"]["i"], P) + _number(r["end"]["s"])) % P
    before = stored.sparkSession.createDataFrame(carried, "part int, conv_id long, n0 long, s0 binary")
    joined = pieces.join(F.broadcast(before), ["part", "conv_id"], "left").withColumns(
        {"n0": F.coalesce("n0", F.lit(0).cast("long")), "s0": F.coalesce("s0", F.lit(_bytes(0)))}
    )
    return durable(joined.mapInArrow(_shifted(seed), "conv_id long, i long, s binary, turn binary, chars long"))


def _join(rows: DataFrame, facts: DataFrame, keys: list[str], hot: DataFrame | None) -> DataFrame:
    """Join one row of facts per key to all rows; the few keys of very many rows (``hot``) by broadcast."""
    if hot is None:
        return rows.join(facts, keys)
    h = F.broadcast(hot)
    few = F.broadcast(facts.join(h, keys, "left_semi"))
    return rows.join(h, keys, "left_semi").join(few, keys).unionByName(
        rows.join(h, keys, "left_anti").join(facts.join(h, keys, "left_anti"), keys)
    )


def _hot(counts: DataFrame, count: str, keys: list[str], hot_rows: int) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows and ``HOT_SHARE`` of all, so at most 1 / share; None if there are none."""
    total = counts.agg(F.sum(count)).first()[0] or 0
    many = counts.where(F.col(count) > max(hot_rows, int(total * HOT_SHARE))).select(*keys)
    return many if many.limit(1).count() else None


def _members(turns: DataFrame, head: Column, base_of: Column, most: int, seed: int, hot_turns: int):
    """A row per rebuilt conversation and depth, and the conversations with very many of them."""
    zero = F.lit(_bytes(0))
    # At most ``most`` turns of each conversation are ever a head.
    heads = turns.groupBy("conv_id").agg(
        F.max("i").alias("n"),
        F.sort_array(F.collect_list(F.when(F.col("i") <= most, F.struct("i", "s", "turn", "chars")))).alias("first"),
    )
    convs = heads.select("conv_id", "n", "first", head.cast("int").alias("h"), base_of.alias("base"))
    bases = heads.select(F.col("conv_id").alias("base"), F.col("first").alias("base_first"))
    facts = convs.join(bases, "base", "left").withColumn("head", F.slice(F.coalesce("base_first", F.array()), 1, F.col("h")))

    def last(turns_of: str) -> Column:
        return F.coalesce(F.element_at(F.col(turns_of), -1)["s"], zero)

    facts = durable(
        facts.withColumn("k", F.size("head").cast("long"))
        .withColumn("skipped", F.slice("first", 1, F.col("h")))
        .select(
            "conv_id", "n", "h", "k", "head",
            F.when(F.col("k") > 0, last("head")).otherwise(zero).alias("head_s"),
            F.when((F.col("h") > 0) & (F.col("n") > 0), last("skipped")).otherwise(zero).alias("skipped_s"),
            (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
        )
    )
    hot = _hot(facts, "length", ["conv_id"], hot_turns)
    own = _join(turns, facts.drop("head", "n"), ["conv_id"], hot).where("i > h")
    schema = "conv_id long, depth long, fp binary, parent_fp binary, turn binary, chars long, length long"
    placed = F.posexplode("head").alias("j", "t")
    borrowed = facts.select("conv_id", "length", "head", placed).select(
        "conv_id",
        (F.col("j") + 1).cast("long").alias("depth"),
        F.col("t.s").alias("fp"),
        F.when(F.col("j") == 0, zero).otherwise(F.try_element_at("head", F.col("j"))["s"]).alias("parent_fp"),
        F.col("t.turn").alias("turn"),
        F.col("t.chars").alias("chars"),
        "length",
    )
    root = facts.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), zero.alias("fp"), F.lit(None).cast("binary").alias("parent_fp"),
        F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("chars"), "length",
    )
    members = own.mapInArrow(_composed(seed), schema).unionByName(borrowed).unionByName(root)
    return durable(members), hot


NODE = ["depth", "fp"]


def _sound(nodes: DataFrame, stored: DataFrame) -> bool:
    """Whether equal fingerprints are equal sequences: one parent and one turn in each node, one text for each turn."""
    mixed = nodes.where("NOT (least_turn <=> most_turn AND parent_fp <=> most_parent)")
    said = F.struct("role", "text")
    texts = stored.groupBy("turn").agg(F.min(said).alias("least"), F.max(said).alias("most")).where("least != most")
    return not (mixed.limit(1).count() or texts.limit(1).count())


def _ends(members: DataFrame) -> DataFrame:
    """(depth, fp, ends_sha256): hash of the ids, in order, of the conversations that end in a node.

    Ids are listed in pieces of 2^PIECE_BITS possible ids, and the pieces of a node pass one by one through a running
    hash, so the members of a node are never held together.
    """
    pieces = (
        members.where("depth = length")
        .groupBy(*NODE, F.shiftright("conv_id", PIECE_BITS).alias("piece"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    )

    def run(batches):
        node, digest = None, None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.binary()), pa.array([digest.hexdigest()])],
                names=[*NODE, "ends_sha256"],
            )

        for batch in batches:
            for depth, fp, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if (depth, fp) != node:
                    if node:
                        yield done()
                    node, digest = (depth, fp), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
        if node:
            yield done()

    ordered = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece").select(*NODE, "ids")
    return ordered.mapInArrow(run, "depth long, fp binary, ends_sha256 string")


def prefix_trie(
    rows: DataFrame, head: Column, base_of: Column, most_head: int, hot_turns: int = HOT_TURNS
) -> DataFrame:
    """The trie of all rebuilt conversations, one row per node.

    ``rows`` has (conv_id, turn, role, text).  ``head`` (from ``conv_id``, 0 to ``most_head``) is how many turns a rebuilt
    conversation takes from the conversation ``base_of`` instead of its own; fewer if that has fewer, none if it is not
    there.  A node is a distinct sequence of first turns; the root has none.  Columns: ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id`` (null for the root), ``n_convs`` (members), ``n_children``, ``n_leaves`` and
    ``saved_tokens`` over the subtree with its top, ``ends_sha256`` (of the ids of conversations that end here).

    Other columns of ``rows`` play no part; repeated rows are turns of their own; without conversations there are no nodes.
    """
    for seed in range(SEEDS):
        stored = stored_turns(rows, seed)
        members, hot = _members(fingerprints(stored, seed), head, base_of, most_head, seed, hot_turns)
        nodes = durable(
            members.groupBy(*NODE).agg(
                F.min("conv_id").alias("conv_id"),
                F.count(F.lit(1)).alias("n_convs"),
                F.count_if(F.col("depth") == F.col("length")).alias("n_ends"),
                F.max("chars").alias("chars"),
                F.min("turn").alias("least_turn"),
                F.max("turn").alias("most_turn"),
                F.min("parent_fp").alias("parent_fp"),
                F.max("parent_fp").alias("most_parent"),
            )
        )
        if _sound(nodes, stored):
            break
    else:
        raise RuntimeError("different turns kept one fingerprint under every hash function")
    cost = (F.col("n_convs") - 1) * F.col("chars")
    plain = nodes.select(*NODE, "conv_id", "parent_fp", "n_convs", "n_ends", cost.alias("cost"))
    # A conversation is the smallest member of its nodes from some depth on, so these nodes are chains to its end.
    chains = durable(running_totals(plain, "depth", ["cost"], keys=["conv_id"]))
    chain = chains.groupBy("conv_id").agg(
        F.min("depth").alias("top"),
        F.max("total_cost").alias("chain_cost"),
        F.max((F.col("n_ends") == F.col("n_convs")).cast("long")).alias("leaf"),
    )
    # Below a node are the rest of its own chain and the whole chains of its other members.
    below = (
        _join(members.select("conv_id", *NODE), chain, ["conv_id"], hot)
        .where("depth < top")
        .groupBy(*NODE)
        .agg(F.sum("chain_cost").alias("more_cost"), F.sum("leaf").alias("more_leaves"))
    )
    children = durable(
        plain.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_fp").alias("fp")).agg(
            F.count(F.lit(1)).alias("n_children")
        )
    )
    full = _join(chains, chain.select("conv_id", "top", "leaf"), ["conv_id"], hot)
    # Only the top of a chain has a parent outside it.
    tops = full.where("depth = top AND depth > 0").select(
        (F.col("depth") - 1).alias("depth"), F.col("parent_fp").alias("fp"), F.col("conv_id").alias("child")
    )
    parents = plain.select(*NODE, F.col("conv_id").alias("above"))
    above = _join(tops, parents, NODE, _hot(children, "n_children", NODE, hot_turns)).select(
        (F.col("depth") + 1).alias("depth"), F.col("child").alias("conv_id"), "above"
    )
    number = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    return (
        full.join(children, NODE, "left")
        .join(below, NODE, "left")
        .join(_ends(members), NODE, "left")
        .join(above, ["depth", "conv_id"], "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("above")).alias("parent_conv_id"),
            "n_convs",
            number("n_children").alias("n_children"),
            (F.col("leaf") + number("more_leaves")).alias("n_leaves"),
            (F.col("total_cost") - F.col("cum_cost") + F.col("cost") + number("more_cost")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
