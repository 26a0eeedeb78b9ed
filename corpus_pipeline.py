"""A training corpus from ``documents``: quality, near-duplicates, repeats, benchmark passages, mixture.

Each stage takes the documents that the one before kept, written as Parquet and read again, and all but the last
return the columns of ``documents``.  SQL cannot express the stages (hash sketches, suffix order, fitted models), so
``ORACLE_SQL`` is None and tests/llm holds each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telequal.llm import decontaminate, minhash, mixing, quality, repeats
from telequal.session import scratch_path

#: Bytes of a repeated passage that the third stage cuts: passages of over 50 words are longer in every language here.
REPEAT_BYTES = 200


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counted rules and the likelihood ratio."""
    return quality.filtered(docs, _table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each component of five-word shingles at 0.8."""
    return minhash.deduplicated(docs, width=5, similarity=0.8)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated passages; ``n_chars`` follows the text."""
    cut = repeats.cut_repeats(docs, REPEAT_BYTES, keep_first=True)
    return cut.selectExpr(*["length(text) AS n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns]).selectExpr(
        *[f"CAST(`{c}` AS {docs.schema[c].dataType.simpleString()}) AS `{c}`" for c in docs.columns]
    )


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the rate at which the mixture uses them."""
    return mixing.mixed(docs, _table(spark, sf_dir, "labels"))


STAGES = [
    ("quality rules", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("repeated passages", repeat_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixture", mixture_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, f"stage{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
