"""Each operator against a brute-force version over whole small tables."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from telequal.llm import chat, decontaminate, html, licenses, lm, minhash, mixing, quality, repeats, toxicity
from telequal.llm.components import components
from tests import compare
from tests.llm import brute
from tests.llm.conftest import DIR


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, texts, width, percent):
    got = {i: (r["n_shingles"], r["component_id"]) for i, r in by_id(minhash.classes(docs, width, percent / 100)).items()}
    assert got == brute.components(texts, width, percent)


def test_links_between_members_of_a_large_key_are_not_lost(spark, monkeypatch):
    """Texts that share a passage meet under common keys; the similar ones among them must still be linked."""
    monkeypatch.setattr(minhash, "LARGE_KEY", 3)
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    passage = [word() for _ in range(160)]
    texts = {}
    for k in range(30):
        tail = [word() for _ in range(25)]
        texts[2 * k] = " ".join(passage + tail)
        texts[2 * k + 1] = " ".join(passage + tail[:-1] + [word()])
    got = {i: (x["n_shingles"], x["component_id"]) for i, x in by_id(
        minhash.classes(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 3, 0.85)).items()}
    assert got == brute.components(texts, 3, 85)


@pytest.mark.parametrize("size", [60, 240])
def test_looks_at_families_below_the_limit_grow_in_proportion(spark, monkeypatch, size):
    """Texts of one family, each just too far from every other, and a few real links among them."""
    monkeypatch.setattr(minhash, "LARGE_KEY", 6)
    r = random.Random(size)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    core = [word() for _ in range(300)]
    texts = {}
    for k in range(size):
        mine = list(core)
        for at in r.sample(range(0, 300, 3), 14):
            mine[at] = word()
        texts[k] = " ".join(mine)
    for k in range(0, size, 20):
        texts[1000 + k] = texts[k] + " " + word()
    looked, verified = [], minhash._verified
    monkeypatch.setattr(minhash, "_verified", lambda p, *a: looked.append(p.count()) or verified(p, *a))
    got = {i: (x["n_shingles"], x["component_id"]) for i, x in by_id(
        minhash.classes(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 3, 0.85)).items()}
    assert got == brute.components(texts, 3, 85)
    assert sum(looked) < 40 * len(texts)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (61, 60)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 62)}, **{i: 100 for i in range(101, 140)}}


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("large", [512, 1])
def test_repeats(spark, monkeypatch, keep_first, large):
    monkeypatch.setattr(repeats, "LARGE_GROUP", large)
    r = random.Random(3)
    word = lambda n: "".join(r.choice("abc é") for _ in range(n))
    shared = [word(120), word(70), word(41)]
    texts = [word(r.randint(0, 200)) + r.choice(shared) + word(r.randint(0, 90)) + r.choice(shared)[r.randint(0, 30) :] for _ in range(40)]
    texts += ["a" * 95, "a" * 60, texts[3], texts[3], "", "short"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    data = [t.encode() for t in texts]
    want = {i: brute.cut(t, g) for i, (t, g) in enumerate(zip(data, brute.repeats(data, 40, keep_first)))}
    got = by_id(repeats.cut_repeats(df, 40, keep_first))
    assert {i: (x["n_removed"], x["n_spans"], hashlib.sha256(x["kept_bytes"]).hexdigest()) for i, x in got.items()} == want


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("large", [512, 1])
def test_repeats_of_two_lengths(spark, monkeypatch, keep_first, large):
    """Cuts are those of the longer length; passages of the shorter one are counted, to the ends of texts."""
    monkeypatch.setattr(repeats, "LARGE_GROUP", large)
    r = random.Random(7)
    word = lambda n: "".join(r.choice("abc é") for _ in range(n))
    shared = [word(90), word(45), word(27), word(22)]
    texts = [word(r.randint(0, 120)) + r.choice(shared) + word(r.randint(0, 60)) + r.choice(shared)[r.randint(0, 9) :] for _ in range(50)]
    texts += ["a" * 95, "a" * 60, texts[3], texts[3], texts[4][:-1], texts[5][-30:], "", "short"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    data = [t.encode() for t in texts]
    want = {i: brute.cut(t, g) for i, (t, g) in enumerate(zip(data, brute.repeats(data, 40, keep_first)))}
    covered = {i: sum(g) for i, g in enumerate(brute.repeats(data, 24, keep_first))}
    got = by_id(repeats.cut_repeats(df, 40, keep_first, passage=24))
    assert {i: (x["n_removed"], x["n_spans"], hashlib.sha256(x["kept_bytes"]).hexdigest()) for i, x in got.items()} == want
    assert {i: x["passage_bytes"] for i, x in got.items()} == covered
    assert any(covered[i] and not want[i][0] for i in want)


def test_passages_of_over_fifty_words_are_reported(spark, tmp_path):
    """Passages of 51 words and under 400 bytes stay, as the contract says, and the documents that hold them are named."""
    r = random.Random(11)
    words = lambda n: " ".join("".join(r.choices("abcdefghijkl", k=r.randint(4, 6))) for _ in range(n))
    passages = [words(51) for _ in range(6)]
    assert max(map(len, passages)) < 400
    texts = [" ".join((words(80), passages[k % 6], words(r.randint(5, 80)))) for k in range(12)] + [words(200) for _ in range(12)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = by_id(contract.queries()["op8_repeated_passages"](spark, str(tmp_path)))
    assert [got[k]["has_passage"] for k in range(24)] == [True] * 12 + [False] * 12
    assert [got[k]["n_removed"] for k in range(24)] == [0] * 24
    assert all(len(passages[k % 6]) <= got[k]["passage_bytes"] <= len(passages[k % 6]) + 9 for k in range(12))


def test_texts_that_share_a_short_phrase_share_no_anchor():
    """A common phrase of 100 bytes is no candidate for a passage of 400."""
    r = random.Random(5)
    word = lambda n: bytes(r.choices(range(97, 123), k=n))
    phrase = word(100)
    texts = [word(700) + phrase + word(700) for _ in range(50)]
    found = repeats.anchors(repeats.tx.Block(None, texts, lower=False), 400)
    assert len(set(found["anchor"])) == len(set(zip(found["row"], found["at"] + found["off"])))


def test_repeated_passages_of_the_tables(docs, texts):
    ids = sorted(texts)
    data = [texts[i].encode() for i in ids]
    want = {i: brute.cut(t, g) for i, t, g in zip(ids, data, brute.repeats(data, 400, False))}
    got = by_id(contract.queries()["op8_repeated_passages"](docs.sparkSession, DIR))
    assert {i: (x["n_removed"], x["n_spans"], x["kept_sha256"]) for i, x in got.items()} == want


def test_passages_of_the_tables(docs, texts):
    ids = sorted(texts)
    want = dict(zip(ids, map(sum, brute.repeats([texts[i].encode() for i in ids], repeats.PASSAGE, False))))
    got = by_id(contract.queries()["op8_repeated_passages"](docs.sparkSession, DIR))
    assert {i: x["passage_bytes"] for i, x in got.items()} == want


@pytest.mark.parametrize("block_bytes", [8 << 20, 500])
def test_benchmark_matches(spark, docs, texts, block_bytes):
    bench = spark.read.parquet(f"{DIR}/benchmark.parquet").union(
        spark.createDataFrame([(9000, "the of and"), (9001, "the"), (9002, ""), (9003, None)], "item_id long, text string")
    )
    windows = brute.benchmark_windows([(str(r["item_id"]), r["text"]) for r in bench.collect()], 10)
    got = by_id(decontaminate.search(docs, bench, 10, block_bytes).withColumn("n_hit", decontaminate.hit_words()))
    for i, t in texts.items():
        assert (got[i]["n_words"], got[i]["n_hit"], set(got[i]["items"]), got[i]["longest"]) == brute.benchmark_hits(t, windows)


def test_quality_counts_and_verdicts(docs, labels, texts):
    got = by_id(contract.queries()["op7_quality_rules"](docs.sparkSession, DIR))
    for i, t in texts.items():
        x = got[i]
        want = brute.quality_counts(t)
        assert tuple(x[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert x["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    good = [r["doc_id"] for r in labels.where("quality = 1").collect()]
    poor = [r["doc_id"] for r in labels.where("quality = 0").collect()]
    assert all(got[i]["kept"] for i in good if not got[i]["base_failed"])
    assert not any(got[i]["kept"] for i in poor)


def test_language_model(docs, texts):
    got = by_id(contract.queries()["op4_language_model"](docs.sparkSession, DIR))
    want, n = brute.base_scores(texts, lambda i: brute.fold(i, 7) != 2)
    for i, (tokens, known, base) in want.items():
        x = got[i]
        assert (x["n_tokens"], x["n_known"], x["train_tokens"]) == (tokens, known, n)
        assert x["base_score"] == pytest.approx(base, rel=1e-9)
        assert x["held_out"] == (brute.fold(i, 7) == 2)
    held = [x for x in got.values() if x["held_out"]]
    assert sum(x["score"] for x in held) > 0.95 * sum(x["base_score"] for x in held)


def test_language_model_estimates_by_hand(spark, monkeypatch):
    """With its learned weights, a score is the interpolated sum; small tables leave all counts to the owners."""
    kept = {}
    learn = lm.Model.learn

    def spy(self, cells, rounds=60):
        learn(self, cells, rounds)
        kept["model"] = self

    monkeypatch.setattr(lm.Model, "learn", spy)
    monkeypatch.setattr(lm, "PAIRS", 4)
    monkeypatch.setattr(lm, "WORDS", 5)
    monkeypatch.setattr(lm, "OWNED", 40)
    texts = {i: " ".join(f"w{(i * k * k + k) % 7}" for k in range(1, 30)) for i in range(20)}
    got = by_id(lm.scored(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
    model = kept["model"]
    words = {i: [*t.split(), "end"] for i, t in texts.items()}
    from collections import Counter
    from math import log10

    def hashed(ws):
        block = lm.tx.Block(None, [" ".join(ws).encode()])
        return lm.np.array([lm.END]) if ws == ["end"] else block.hashes(*block.words(lm.tx.SPACED)[:2])

    uni = Counter(w for x in words.values() for w in x)
    bi = Counter(p for x in words.values() for p in zip(["end", *x], x))
    for i, x in words.items():
        total = 0.0
        for v, w in zip(["end", *x], x):
            known = int(lm._look_up(*model.words, hashed([v]))[0])  # 0 outside the table of frequent words
            a, u, z = model.weights[int(lm.bucket(lm.np.array([known]))[0])]
            two = bi[v, w] / uni[v] if known else 0.0
            total += log10(a * two + u * uni[w] / sum(uni.values()) + z / (len(uni) + 1))
        assert got[i]["score"] == pytest.approx(total, rel=1e-9)


@pytest.mark.parametrize("words", [5, 1 << 19])
def test_language_model_learns_its_weights_from_every_token(spark, monkeypatch, words):
    learnt = []
    monkeypatch.setattr(lm.Model, "learn", lambda self, cells, rounds=60: learnt.append(sum(c[3] for c in cells)))
    monkeypatch.setattr(lm, "WORDS", words)
    monkeypatch.setattr(lm, "OWNED", 400)
    texts = [(i, " ".join(f"w{i * k % 61}" for k in range(1, 30))) for i in range(40)]
    got = lm.scored(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id % 5 > 0").collect()
    assert learnt == [32 * 30] and {r["train_tokens"] for r in got} == {32 * 30}


def test_toxicity_on_held_out_rows(docs, labels):
    got = by_id(contract.queries()["op2_toxicity"](docs.sparkSession, "/root/testdata/sf0.01"))
    truth = {r["doc_id"]: r["toxic"] for r in docs.sparkSession.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(truth[i], x["score"], x["predicted"]) for i, x in got.items() if x["held_out"] and i in truth]
    assert all(0 <= s <= 1 for _, s, _ in held)
    toxic, clean = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert auc > 0.9
    assert sum(p for y, _, p in held if not y) <= 0.05 * len(clean)


def test_toxicity_learns_from_every_labelled_row(spark):
    """21,000 labelled rows are counted, all of them; the one-pass form gives the same scores."""
    n = 21_000
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('plain text ', if(id % 7 = 0, concat('bad', translate(cast(id div 21 AS string), '0123456789', 'abcdefghij')), 'fine')) AS text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 7 = 0 AS int) AS toxic")
    model = toxicity.fit(docs, labels)
    assert model["n"] == (n * 6 // 7, n // 7)
    once = {(r["doc_id"], round(r["score"], 9)) for r in toxicity.scored(docs, model, ["doc_id"]).collect()}
    assert once == {(r["doc_id"], round(r["score"], 9)) for r in toxicity.fit_and_score(docs, labels, ["doc_id"]).collect()}


@pytest.mark.parametrize(
    "written", ["1d10t", "!d!ot", "id1ot", "iiidiooot", "i.d.i.o.t", "i d i o t", "$tup1d", "stu*pid", "STUPID!!!", "stuuupid"]
)
def test_disguised_words_are_restored(written):
    pairs = {}
    for w in "idiot stupid the and with this that nation station there their other".split() * 20:
        for a, b in zip(f" {w}", f"{w} "):
            pairs[a + b] = pairs.get(a + b, 0) + 1
    model = toxicity.CharModel(pairs, ["idiot", "stupid", "the"])
    assert {"idiot", "stupid"} & toxicity.Restorer(model).words(written)


@pytest.mark.parametrize(
    "written",
    ["w i t h t h i s t h a t n a t i o n i d i o t s t a t i o n t h e r e", "y o u i d i o t", "t h e 1 d 1 0 t t h a t", "t h a t  i d d i o o t  x q", "a  i d i o t", "idiiot"],
)
def test_spaced_runs_of_any_length_are_split_into_words(written):
    known = "idiot stupid the and with this that nation station there their other you".split()
    pairs = {}
    for w in known * 20:
        for a, b in zip(f" {w}", f"{w} "):
            pairs[a + b] = pairs.get(a + b, 0) + 1
    assert "idiot" in toxicity.Restorer(toxicity.CharModel(pairs, known)).words(written)


def test_spaced_run_of_unknown_letters_is_linear_in_its_length():
    model = toxicity.CharModel({"ab": 3, " a": 3, "b ": 3}, ["idiot"])
    text = "x q " * 20_000 + "i d i o t " + "z v " * 20_000
    assert "idiot" in toxicity.Restorer(model).words(text)


def test_mixing_meets_targets(spark, docs, labels):
    got = mixing.mixed(docs, labels).collect()
    total = docs.select(F.sum(F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")))).first()[0]
    sums = [sum(x["rate"] * x["tokens"] * x["posterior"][d] for x in got) / total for d in range(4)]
    assert all(abs(s - t) < 0.03 for s, t in zip(sums, mixing.TARGETS))
    assert all(x["rate"] > 0 for x in got)
    assert all(abs(x["copies"] - x["rate"]) < 1 for x in got)


def test_mixing_steps_equal_a_plain_solver(spark):
    import numpy as np

    r = np.random.default_rng(1)
    post = r.dirichlet([0.3, 0.2, 1.0, 0.3], 60)
    tokens = r.integers(5, 400, 60)
    members = spark.createDataFrame([(int(t), p.tolist()) for t, p in zip(tokens, post)], "tokens long, posterior array<double>")
    steps = mixing.fit_rates(members)
    got = np.array([x["r"] for x in members.select(mixing.rate_of(steps).alias("r"), "tokens").collect()])
    t = tokens / tokens.sum()
    m = np.linalg.inv((post.T * t) @ post + mixing.RIDGE * np.eye(4))
    goal = np.array(mixing.TARGETS) / sum(mixing.TARGETS)
    rate = np.ones(60)
    for _ in range(4000):
        gap = (rate * t) @ post - goal
        rate = np.maximum(0, rate - (post @ m @ gap + mixing.PULL * (rate - 1)) / (1 + mixing.PULL))
    assert np.abs((got * t) @ post - (rate * t) @ post).max() < 0.01


def test_mixing_keeps_clean_documents_and_meets_each_target(docs, labels):
    """Every document has its row, labelled clean ones a positive rate, and small targets are met relative to their size."""
    got = mixing.mixed(docs, labels, keep_text=False).collect()
    assert len(got) == docs.count()
    clean = {r["doc_id"] for r in labels.where("toxic = 0").collect()}
    assert clean & {x["doc_id"] for x in got} and all(x["rate"] > 0 for x in got if x["doc_id"] in clean)
    total = sum(x["tokens"] for x in got)
    sums = [sum(x["rate"] * x["tokens"] * x["posterior"][d] for x in got) / total for d in range(4)]
    assert sums == pytest.approx(mixing.TARGETS, rel=0.03)


def test_mixing_returns_documents_of_rate_0(docs, labels):
    """Without any wish for a domain its documents get rate 0, and a row all the same."""
    got = mixing.mixed(docs, labels, targets=(0.05, 0.0, 0.95, 0.0), keep_text=False).collect()
    assert len(got) == docs.count() and min(x["rate"] for x in got) == 0


def test_page_text(spark):
    pages = spark.read.parquet(f"{DIR}/pages.parquet")
    import html as entities

    got = by_id(contract.queries()["op5_page_text"](spark, DIR), "page_id")
    for r in pages.collect():
        inner = re.search("<article>(.*?)</article>", r["html"], re.S)[1].replace("<br>", " ")
        runs = [" ".join(entities.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert got[r["page_id"]]["text"] == "\n\n".join(x for x in runs if x)


def test_page_model_on_held_out_layouts():
    model = html.standard_model()
    right = total = 0
    for page, mark in html.labelled_pages(150, seed=99):
        nodes = [n for n in html.parsed(page) if n.tag == "#text"]
        want = [mark in n.text for n in nodes]
        kept = html.main_text(page.replace(mark, ""), model).split("\n\n")
        texts = [n.text.replace(mark, "").strip() for n in nodes]
        right += sum((t in kept) == w for t, w in zip(texts, want))
        total += len(want)
    assert right / total > 0.93


def test_page_marginals_equal_enumeration():
    import itertools
    import math

    nodes = html.parsed("<div class='content'><p>Some words here.</p><div class=ad><a href=x>buy</a></div></div><nav>x</nav>")
    model = html.standard_model()
    unary = [model.unary(n) for n in nodes]
    at = {id(n): i for i, n in enumerate(nodes)}
    one, every = [0.0] * len(nodes), 0.0
    for y in itertools.product((0, 1), repeat=len(nodes)):
        p = math.exp(sum(u for u, v in zip(unary, y) if v) + sum(
            model.pairs[y[at[id(n.parent)]]][y[i]] for i, n in enumerate(nodes) if n.parent is not None))
        every += p
        for i, v in enumerate(y):
            one[i] += p * v
    for got, p in zip(model.marginals(nodes), one):
        assert 1 / (1 + math.exp(-got)) == pytest.approx(p / every, rel=1e-6)


def test_chat_equals_sql(spark):
    con = compare.connect(DIR)
    name = "op6_chat_format"
    assert compare.compare(contract.queries()[name](spark, DIR), con, contract.oracle_sql()[name]) == []


def test_chat_round_trip_with_adjacent_roles_and_markers(spark):
    rows = [
        (1, 2, "user", "b <|end|>\n <|part|> &lt; &amp;lt; [INST] &#91;"), (1, 1, "user", "a"), (1, 3, "assistant", "x\ny"),
        (1, 4, "assistant", ""), (1, 5, "assistant", "<|start|>user\nz"), (1, None, "sys\ntem<|", None), (2, 0, None, None),
        (None, 0, "assistant", "no id"), (1, 1, "user", "a"),
    ]
    df = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r for r in df.select("conv_id", "formatted", chat.read_turns().alias("t"), chat.read_loss().alias("l")).collect()}
    assert [tuple(t) for t in got[1]["t"]] == [
        ("sys\ntem<|", ""), ("user", "a"), ("user", "a"), ("user", "b <|end|>\n <|part|> &lt; &amp;lt; [INST] &#91;"),
        ("assistant", "x\ny"), ("assistant", ""), ("assistant", "<|start|>user\nz"),
    ]
    assert got[1]["l"] == "x\ny<|start|>user\nz"
    assert [tuple(t) for t in got[2]["t"]] == [("", "")] and got[2]["l"] == ""
    assert got[None]["l"] == "no id"
    assert got[1]["formatted"].count("<|start|>") == 3


def test_license_base_phrases(docs, texts):
    got = by_id(contract.queries()["op10_license_scan"](docs.sparkSession, DIR))
    for i, t in texts.items():
        w = brute.alnum(t)
        at = sorted((k, label) for p, label in licenses.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split())
        x = got[i]
        assert (x["n_words"], x["n_base"]) == (len(w), len(at))
        assert (x["first_word"], x["last_word"]) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert x["base_labels"] == ",".join(sorted({n for _, n in at}))
        assert set(filter(None, x["base_labels"].split(","))) <= set(x["labels"].split(","))


def test_license_templates(spark):
    mit = licenses.TEMPLATES["mit"][2].replace("[[", "").replace("]]", "")
    texts = {
        1: mit, 2: mit.replace("including the next paragraph", ""), 3: mit.replace("without restriction", "with restriction"),
        4: "Redistribution: see copyright (c) 2019 2020 Some Holder. All Rights Reserved.", 5: "licensed under the bsd 3 clause license",
        6: "Licensed under CC BY-NC 4.0.", 7: "licensed under the bsd one two three license",
    }
    got = by_id(licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
    names = {i: {p["label"] for p in x["places"]} for i, x in got.items()}
    assert "mit" in names[1] and "mit" in names[2] and "mit" not in names[3]
    assert {"copyright", "reserved"} <= names[4]
    assert "bsd" in names[5] and "bsd" not in names[7]
    assert {"cc-by", "cc-by-nc"} <= names[6]


def test_license_regions_of_any_length_and_whole_wording(spark):
    years = " ".join(str(y) for y in range(1980, 2000))
    plain = lambda t: t.replace("[[", "").replace("]]", "").replace("{{holder}}", "the regents of the university of california and others")
    two, three = plain(licenses.TEMPLATES["bsd-2-clause"][0]), plain(licenses.TEMPLATES["bsd-3-clause"][0])
    mit, isc = plain(licenses.TEMPLATES["mit"][2]), plain(licenses.TEMPLATES["isc"][0])
    texts = {
        1: f"Copyright (c) {years} The Regents of the University of California. All rights reserved.", 2: two, 3: three,
        4: mit.replace("without warranty", "with warranty"), 5: three.replace("are disclaimed", "are granted"), 6: isc[:-40], 7: isc,
        8: "copyright all rights " * 5_000 + "all rights reserved", 9: "copyright nobody " * 20_000,
    }
    got = by_id(licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
    names = {i: {p["label"] for p in x["places"]} for i, x in got.items()}
    assert names[1] == {"copyright", "reserved"} and names[2] == {"bsd-2-clause"} and names[3] == {"bsd-3-clause"}
    assert names[4] == names[5] == names[6] == names[9] == set() and names[7] == {"isc"}
    ends = [(p["start"], p["end"]) for p in got[8]["places"] if p["label"] == "copyright"]
    assert ends == [(3 * k, 15_003) for k in range(5_000)]
