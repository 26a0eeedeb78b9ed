"""Quality rules: counted rules and a hashed n-gram log-likelihood ratio, all in built-in functions.

Two multinomials over ``bins`` hashed words and word pairs are counted in one pass: one over trusted documents
(labelled ``quality`` 1, at most ``trusted_rows`` of them), one over the whole corpus.  A document's score is the
mean over its n-grams of log(trusted / corpus); it is kept if that is at least ``threshold``.  The trusted side is
mixed with a share of the corpus, so a bin that no trusted document happens to hold cannot outweigh a text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telequal.llm import words as w

BINS = 1 << 16
TRUSTED_ROWS = 20_000
THRESHOLD = -0.35
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SMOOTHING = 0.02


def repeated_words(words: str) -> Column:
    """Words inside three-word windows that occur twice or more in the text."""
    c = F.col(words)
    return F.transform(
        F.slice(c, 1, F.greatest(F.size(c) - 2, F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x, F.get(c, i + 1), F.get(c, i + 2)).alias("gram"), i.alias("at")),
    )


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` with words and the counts that the fixed rules need."""
    text = w.text_of()
    out = docs.withColumn("_words", w.spaced_words(text))
    out = out.withColumn("_grams", F.sort_array(repeated_words("_words")))
    grams = F.col("_grams")
    out = out.withColumn(
        "_again",
        F.sort_array(
            F.transform(
                F.filter(
                    grams,
                    lambda x, i: ((i > 0) & (F.get(grams, i - 1)["gram"] == x["gram"]))
                    | F.coalesce(F.get(grams, i + 1)["gram"] == x["gram"], F.lit(False)),
                ),
                lambda x: x["at"],
            )
        ),
    )
    covered = F.aggregate(
        "_again",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda done, p: F.struct(p.alias("last"), (done["n"] + F.least(F.lit(3), p - done["last"])).alias("n")),
        lambda done: done["n"],
    )
    lines = F.filter(F.split(text, "\n"), lambda x: w.without(x, w.BLANKS) != "")
    return (
        out.withColumn("_lines", lines)
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "word_chars": F.length(w.without(text, w.BLANKS)).cast("long"),
                "n_symbols": (F.length(text) - F.length(w.without(text, "#*$%&|<>"))).cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": covered,
            }
        )
        .drop("_grams", "_again", "_lines")
    )


def fit(
    docs: DataFrame, labels: DataFrame, bins: int = BINS, trusted_rows: int = TRUSTED_ROWS
) -> list[float]:
    """Log-likelihood ratio of each bin; all zero if there is no trusted document or no word at all."""
    trusted = w.labelled_sample(labels.where("quality = 1"), ["quality"], trusted_rows)
    totals = (
        docs.select("doc_id", w.spaced_words(w.text_of()).alias("_words"))
        .join(trusted, "doc_id", "left")
        .select(F.explode(w.hashed_ngrams("_words", bins)).alias("bin"), F.col("quality").isNotNull().alias("good"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.count_if("good").alias("g"))
        .collect()  # at most `bins` rows
    )
    n, g = sum(r["n"] for r in totals), sum(r["g"] for r in totals)
    out = [0.0] * bins
    if n and g:
        for r in totals:
            raw = r["n"] / n
            out[r["bin"]] = math.log(((1 - SMOOTHING) * r["g"] / g + SMOOTHING * raw) / raw)
    return out


def judged(docs: DataFrame, weights: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``score`` and ``kept``.

    A null or empty text, or one of blanks, has no words: it fails the base rule, with score 0.  Rows repeat as they
    come; an empty table gives an empty result.  Columns of ``docs`` named like the added ones are replaced.
    """
    out = counted(docs).withColumn("_bins", w.hashed_ngrams("_words", len(weights)))
    score = F.when(F.size("_bins") > 0, w.summed("_bins", weights) / F.size("_bins")).otherwise(0.0)
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return (
        out.withColumn("score", score)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
        .drop("_words", "_bins")
    )


def filtered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns only, whatever these are named."""
    own = {c: f"_own{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    # The row number keeps the filter above the word arrays; pushed below, it would split the text once per word.
    passed = judged(docs.withColumnsRenamed(own), fit(docs, labels)).withColumn("_row", F.monotonically_increasing_id())
    passed = passed.where("kept AND _row >= 0")
    return passed.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])
