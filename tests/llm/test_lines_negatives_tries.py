"""Repeated lines, hard negatives and the conversation trie against brute force, on both ways of every size."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from telequal.llm import lines, negatives, tries
from telequal.llm.text import mix
from tests.llm import brute
from tests.llm.conftest import DIR


@pytest.fixture(scope="module")
def lined(spark):
    rng = random.Random(4)
    pool = ["Menu", "  menu\t", "Contact us", "É là", "", " ", "x", "a longer line of its own \r", "Terms"]
    rows = [(i, "\n".join(rng.choice([*pool, f"own {i} {k}"]) for k in range(rng.randint(1, 9)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, "menu\nno id"), (None, "Terms"), (7, "menu\nterms"), (7, "menu\nterms")]
    rows += [(103, "word " * 100_000 + "\nmenu\n" + "tail")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(5).cache()


@pytest.mark.parametrize("sent", [1_000_000, 0])
@pytest.mark.parametrize(("least", "min_chars", "keep_first"), [(10, 1, False), (2, 3, True), (3, 1, True)])
def test_lines_equal_brute_force(lined, sent, least, min_chars, keep_first):
    rows, df = lined
    got = lines.drop_repeated_lines(df, least, min_chars, keep_first, sent_keys=sent)
    want = [(i, *x) for (i, _), x in zip(rows, brute.repeated_lines(rows, least, min_chars, keep_first))]
    order = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted([tuple(r) for r in got.select("doc_id", "text", "n_lines", "n_dropped").collect()], key=order) == sorted(want, key=order)


def test_full_filter_changes_nothing(lined):
    rows, df = lined
    small = lines.seen_twice(df, bits=64)
    assert small.holds(mix(np.arange(1, 999, dtype=np.uint64))).mean() > 0.1  # suspects strangers too
    get = lambda bits: sorted(map(str, lines.drop_repeated_lines(df, 2, bits=bits).collect()))
    assert get(64) == get(None)


def test_filter_holds_repeats_and_few_others(spark):
    rows = [(i, "\n".join(f"line {k}" for k in range(i * 50, i * 50 + 100))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    twice = lines.seen_twice(df)
    keys = {r["n"]: 0 for r in lines.repeated_keys(df, 1, twice=twice).select("n").collect()}
    assert set(keys) <= {1, 2}
    counts = lines.repeated_keys(df, 1, twice=twice).groupBy("n").count().collect()
    found = {r["n"]: r["count"] for r in counts}
    assert found[2] == 199 * 50 and found.get(1, 0) <= 5


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_lines_of_odd_tables(odd, none, sent):
    clash = odd.selectExpr("*", "'own' AS `_gone`", "'own' AS _doc", "'own' AS _lines", "'own' AS `_uid`", "1 AS n_lines")
    got = lines.drop_repeated_lines(clash, 2, sent_keys=sent)
    assert got.columns == [*clash.columns[:-1], "n_lines", "n_dropped"]
    rows = got.collect()
    assert len(rows) == odd.count() and all(r["_gone"] == r["_doc"] == r["uid"] == r["posterior"] == "own" for r in rows)
    by = {r["doc_id"]: r for r in rows}
    assert by[0]["text"] is None and by[0]["n_lines"] == 1 and by[1]["text"] == "" and by[2]["text"] == " \n\t "
    assert by[3]["n_dropped"] == 0 and by[4]["n_dropped"] == 1 and by[4]["text"] == ""
    assert lines.drop_repeated_lines(none, 2, sent_keys=sent).count() == 0


VECTORS = "id long, label int, embedding array<float>"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(6)
    rows = [(i, rng.randrange(4), [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(5)]) for i in range(0, 800, 2)]
    rows += [(1000 + i, rng.randrange(4), [0.5, 0.5, 0.0, 0.0, 0.25]) for i in range(150)]  # copies of one vector
    rows += [(1, None, [1.0] * 5), (3, 1, None), (5, 1, [1.0, None, 1.0, 1.0, 1.0]), (7, 1, [float("nan")] * 5),
             (9, 1, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (None, 1, [1.0] * 5), (11, 2, []), (13, 2, [0.5]), (50, 3, [0.0] * 5)]
    rows = [r for r in rows if r[0] != 50 or r[2] == [0.0] * 5]
    return rows, spark.createDataFrame(rows + rows[:30], VECTORS)


@pytest.mark.parametrize(("values", "chunk"), [(1 << 19, 512), (100, 3)])
def test_negatives_equal_brute_force(vectors, monkeypatch, values, chunk):
    rows, df = vectors
    monkeypatch.setattr(negatives, "BLOCK_VALUES", values)
    monkeypatch.setattr(negatives, "CHUNK_ANCHORS", chunk)
    usable = [r for r in rows if None not in r[:2] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[2])]
    whole = [(i, label, [int(np.floor(256 * x)) for x in v]) for i, label, v in usable]
    whole = [(i, label, v + [0] * (5 - len(v))) for i, label, v in whole]
    want = brute.hard_negatives(whole, {i for i, *_ in whole if i % 50 == 0}, 5, 3, 50, 95)
    got = negatives.mine(negatives.whole_vectors(df), F.col("id") % 50 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert {tuple(r) for r in got.collect()} == want and len(want) > 100


def test_scan_stops_early_and_its_bound_holds():
    rng = np.random.default_rng(0)
    rows = rng.integers(-20, 20, size=(4000, 6))
    rows[:40] = rng.integers(200, 250, size=(40, 6))
    lists, anchor = negatives.Lists(rows), np.array([3, 1, 4, 0, 2, 5])
    scores = rows @ anchor
    looks = list(lists.scan(anchor))
    for seen, found, bound in looks:
        assert (found == scores[seen]).all()
        if bound is not None:
            assert (np.delete(scores, seen) <= bound).all()
    want = sorted(range(4000), key=lambda i: (-scores[i], i))[:5]
    assert [i for i, _ in negatives.best(lists, np.arange(4000), -1, anchor, 5)] == want
    stops = next(len(s) for s, f, b in looks if b is None or b < np.sort(f)[-5])
    assert stops < 1000


def test_scores_of_very_large_components():
    rows = np.array([[1 << 60, 3], [1 << 60, 4], [5, 1 << 60], [-(1 << 62), 0]])
    lists = negatives.Lists(rows)
    assert [i for i, _ in negatives.best(lists, np.arange(4), -1, np.array([1 << 60, 7]), 3)] == [1, 0, 2]
    assert negatives.best(lists, np.arange(4), -1, np.array([1 << 60, 7]), 1)[0][1] == (1 << 120) + 28


def test_negatives_of_odd_tables(spark):
    none = negatives.whole_vectors(spark.createDataFrame([], VECTORS))
    assert negatives.mine(none, F.col("id") % 50 == 0).count() == 0
    alone = spark.createDataFrame([(0, 1, [1.0]), (50, 2, [1.0])], VECTORS)
    assert negatives.mine(negatives.whole_vectors(alone), F.col("id") % 50 == 0).count() == 0
    both = spark.createDataFrame([(0, 2, [1.0]), (0, 1, [0.5])], VECTORS)
    assert [tuple(r) for r in negatives.whole_vectors(both).collect()] == [(0, 1, [128])]


def heads(c: int) -> int:
    return (c * 7 + 3) % 4


def head_column():
    return (F.col("conv_id") * 7 + 3) % 4


def base_column():
    return F.col("conv_id") - F.col("conv_id") % 10


def node_rows(df) -> set:
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = [tuple(r) for r in df.select(*names).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def talks(spark):
    rng = random.Random(8)
    rows = [
        (c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(["hi", "hi", "ö there", "", None]))
        for c in [*range(40), *range(60, 75)]
        for t in range(rng.randint(0, 5) or 1)
    ]
    rows += [(31, t, "user", f"turn {t % 3}") for t in range(120)]  # one conversation has a third of the rows
    rows += [(35, t, "user", f"turn {t % 3}") for t in range(90)]
    rows += [(None, 0, "user", "lost"), (5_000_000_000, 1, "user", "hi")]
    columns = "conv_id long, turn long, role string, text string"
    return rows, spark.createDataFrame(rows, columns).withColumns({"fp": F.lit("own"), "depth": F.lit(1), "part": F.lit(2)})


@pytest.mark.parametrize("hot", [1_000_000, 5])
def test_trie_equals_brute_force(spark, talks, hot, monkeypatch):
    rows, df = talks
    if hot == 5:
        monkeypatch.setattr(tries, "HOT_SHARE", 1e-3)
        monkeypatch.setattr(tries, "PIECE_BITS", 2)
    got = tries.prefix_trie(df.repartition(6), head_column(), base_column(), 3, hot_turns=hot)
    assert node_rows(got) == brute.prefix_trie(rows, heads, lambda c: c - c % 10)


def test_trie_of_odd_tables(spark, talks):
    _, df = talks
    assert tries.prefix_trie(df.limit(0), head_column(), base_column(), 3).count() == 0
    one = df.where("conv_id = 31").limit(1)
    assert len(node_rows(tries.prefix_trie(one, F.lit(0), base_column(), 3))) == 2


def test_long_conversation_is_folded_over_parts(talks):
    _, df = talks
    stored = tries.stored_turns(df.where("conv_id IN (31, 35)"), 0)
    assert stored.where("conv_id = 31").select("part").distinct().count() > 1
    rows = tries.fingerprints(stored, 0).where("conv_id = 31").orderBy("i").collect()
    assert [r["i"] for r in rows] == list(range(1, len(rows) + 1))
    s, base = 0, tries._base(0)
    for r in rows:
        s = (s * base + int.from_bytes(r["turn"], "big")) % tries.P
        assert int.from_bytes(r["s"], "big") == s


def test_mixed_fingerprints_are_noticed_and_hashed_anew(spark, talks, monkeypatch):
    rows, df = talks
    stored = tries.stored_turns(df, 0)
    nodes = spark.createDataFrame([(b"1", b"1", b"0", b"0"), (None, None, None, None)], "least_turn binary, most_turn binary, parent_fp binary, most_parent binary")
    assert tries._sound(nodes, stored)
    assert not tries._sound(nodes.unionByName(nodes.limit(1).withColumn("most_turn", F.lit(b"2"))), stored)
    assert not tries._sound(nodes, stored.withColumn("turn", F.lit(b"one")))
    seeds, sound = [], tries._sound
    monkeypatch.setattr(tries, "_sound", lambda n, s: seeds.append(1) or (len(seeds) > 1 and sound(n, s)))
    got = tries.prefix_trie(df.where("conv_id < 12"), head_column(), base_column(), 3)
    assert node_rows(got) == brute.prefix_trie([r for r in rows if r[0] is not None and r[0] < 12], heads, lambda c: c - c % 10)
    assert len(seeds) == 2


def test_table_conversations(spark):
    rows = spark.read.parquet(f"{DIR}/conversations.parquet")
    plain = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    got = tries.prefix_trie(rows, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6, F.col("conv_id") - F.col("conv_id") % 100, 5)
    assert node_rows(got) == brute.prefix_trie(plain, lambda c: brute.fold(c, 6), lambda c: c - c % 100)
