"""Bigram estimates of contexts outside the table of frequent words."""

from __future__ import annotations

import random
from collections import Counter
from math import log10

import pytest

import __spark_entry__ as contract
from telequal.llm import lm


@pytest.mark.parametrize("owned", [50, 1 << 20])
def test_scores_do_not_depend_on_the_table_of_words(spark, monkeypatch, tmp_path, owned):
    rng = random.Random(7)
    texts = {i: " ".join(f"w{int(rng.paretovariate(0.6)) % 90}" for _ in range(rng.randrange(30))) for i in range(120)}
    rows = [*texts.items(), (1_000, None), (1_001, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    learn = lm.Model.learn

    def spy(self, cells, rounds=60):
        learn(self, cells, rounds)
        kept.append((self, sum(c[3] for c in cells)))

    monkeypatch.setattr(lm.Model, "learn", spy)

    def run():
        return {r["doc_id"]: r for r in contract.queries()["op4_language_model"](spark, str(tmp_path)).collect()}

    whole = run()
    monkeypatch.setattr(lm, "WORDS", 6)
    monkeypatch.setattr(lm, "PAIRS", 4)
    monkeypatch.setattr(lm, "OWNED", owned)
    cut = run()
    (_, learnt), (model, again) = kept
    words = {i: [*(t or "").split(), "end"] for i, t in rows}
    train = [x for i, x in words.items() if not whole[i]["held_out"]]
    uni = Counter(w for x in train for w in x)
    bi = Counter(p for x in train for p in zip(["end", *x], x))
    n = sum(uni.values())
    assert learnt == again == n and len(uni) > 60
    for i, x in words.items():
        total = 0.0
        for v, w in zip(["end", *x], x):
            a, u, z = model.weights[int(lm.bucket(lm.np.array([uni[v]]))[0])]
            total += log10(a * (bi[v, w] / uni[v] if uni[v] else 0.0) + u * uni[w] / n + z / (len(uni) + 1))
        assert cut[i]["score"] == pytest.approx(total, rel=1e-9) and whole[i]["score"] == pytest.approx(total, rel=1e-9)
        assert cut[i]["base_score"] == pytest.approx(whole[i]["base_score"], rel=1e-9)
        assert all(cut[i][c] == whole[i][c] for c in ("held_out", "n_tokens", "n_known", "train_tokens"))
    assert any(w not in uni for x in words.values() for w in x)
