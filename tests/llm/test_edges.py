"""Null, empty, very long, repeated and tied rows, clashing column names and empty tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from telequal.llm import decontaminate, licenses, lm, minhash, mixing, quality, repeats, toxicity
from tests.llm.conftest import DIR


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "c d e f g h i j k l"), (2, None), (None, "one")], "item_id long, text string")


def test_near_duplicates(odd, none):
    rows = minhash.classes(odd).collect()
    assert len(rows) == odd.count()
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert [got[i]["component_id"] for i in range(10)] == [0, 1, 2, 3, 3, 5, 5, 7, 8, 9]
    assert [got[i]["n_shingles"] for i in (0, 1, 2, 5, 7)] == [0, 0, 0, 1, 1]
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert minhash.classes(none).count() == 0
    assert minhash.deduplicated(odd).columns == odd.columns
    assert sorted(r["doc_id"] for r in minhash.deduplicated(odd).where("doc_id IS NOT NULL").collect()) == [0, 1, 2, 3, 5, 7, 8, 8, 8, 9]


def test_toxicity(odd, none, labels, docs):
    model = toxicity.fit(docs, labels)
    got = toxicity.scored(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.scored(none, model).count() == 0
    flat = toxicity.fit(none, labels)
    assert {r["score"] for r in toxicity.scored(odd, flat).collect()} == {0.0}


def test_mixing(odd, none, labels):
    got = mixing.mixed(odd, labels)
    assert got.count() == odd.count() and got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert len(set(got.columns)) == len(got.columns) and got.schema["posterior"].dataType.typeName() == "array"
    assert mixing.mixed(none, labels).count() == 0
    assert mixing.mixed(odd, labels.limit(0)).count() == odd.count()


def test_language_model(odd, none):
    rows = lm.scored(odd).collect()
    assert len(rows) == odd.count()
    got = {r["doc_id"]: r for r in rows}
    assert got[0]["n_tokens"] == got[1]["n_tokens"] == got[2]["n_tokens"] == 1
    assert got[3]["score"] == pytest.approx(got[4]["score"]) and got[3]["n_tokens"] == 60_001
    assert len({r["score"] for r in rows if r["doc_id"] == 8}) == 1
    assert lm.scored(none).count() == 0
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in lm.scored(odd, "false").collect())


def test_quality(odd, none, labels):
    weights = quality.fit(odd, labels)
    got = quality.judged(odd, weights).collect()
    assert len(got) == odd.count() and not any(r["kept"] for r in got if r["n_words"] < 50)
    assert quality.judged(none, quality.fit(none, labels)).count() == 0
    assert quality.filtered(odd, labels).columns == odd.columns


def test_repeats(odd, none):
    got = {r["doc_id"]: r for r in repeats.cut_repeats(odd).collect()}
    assert got[3]["n_removed"] < got[4]["n_removed"] and got[4]["n_removed"] == got[4]["n_bytes"]
    assert got[0]["text"] is None and got[1]["text"] == "" and got[0]["n_bytes"] == 0
    assert repeats.cut_repeats(odd).count() == odd.count()
    assert repeats.cut_repeats(none).count() == 0


@pytest.mark.parametrize("size", [8 << 20, 10])
def test_items_of_one_id_are_one(spark, size):
    words = [f"w{i}" for i in range(40)]
    items = [(7, " ".join(words[:15])), (7, " ".join(words[15:30])), (7, " ".join(words[:15])), (8, " ".join(words[25:]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    got = decontaminate.search(docs, bench, block_bytes=size).first()
    assert sorted(got["items"]) == ["7", "8"] and [tuple(x) for x in got["spans"]] == [(0, 40)]


def test_benchmark(odd, none, bench):
    got = decontaminate.search(odd, bench)
    assert got.count() == odd.count()
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[8]["items"] == ["1"] and rows[8]["spans"][0]["start"] == 2 and rows[5]["items"] == [""]
    assert rows[0]["items"] == [] and rows[0]["n_words"] == 0
    assert decontaminate.search(none, bench).count() == 0
    assert decontaminate.search(odd, bench.limit(0)).where(F.size("spans") > 0).count() == 0
    assert decontaminate.decontaminate(odd, bench).columns == odd.columns


def test_licenses(odd, none):
    assert licenses.scan(odd).count() == odd.count()
    assert licenses.scan(none).count() == 0


def test_pages(spark):
    from telequal.llm import html

    rows = [(1, None, None), (2, "u", ""), (3, "u", "<p>a<b>c"), (None, "u", "<<<>>&bad; &amp;"), (3, "u", "<div " * 5000), (4, "u", "<div>" * 3000 + "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own"))
    got = html.extracted(df).collect()
    assert len(got) == len(rows) and got[0]["text"] == got[1]["text"] == ""
    assert html.extracted(df.limit(0)).count() == 0


def test_stages_of_the_pipeline(spark, odd, none):
    own = ["doc_id", "text", "lang", "source", "n_chars"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        for docs in (odd, none):
            out = stage(spark, docs.select(*own), DIR)
            assert out.columns[:5] == own if k == 4 else out.columns == own
            out.count()


def test_pipeline_keeps_clean_documents(spark, labels):
    out = corpus_pipeline.run(spark, DIR)
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    assert 0 < out.count() <= docs.count()
    assert out.select("doc_id").distinct().count() == out.count()


def test_no_passage_of_over_fifty_words_is_left_in_two_documents(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    one = corpus_pipeline.near_duplicate_stage(spark, docs, DIR)
    cut = corpus_pipeline.repeat_stage(spark, one, DIR)
    assert cut.columns == docs.columns

    def shared(df):
        seen = {}
        for r in df.select("doc_id", "text").collect():
            words = (r["text"] or "").split()
            for i in range(len(words) - 50):
                seen.setdefault(tuple(words[i : i + 51]), set()).add(r["doc_id"])
        return sum(len(x) > 1 for x in seen.values())

    assert shared(one) > 0 and shared(cut) == 0
