"""Word and n-gram columns from built-in functions only; a null text counts as empty everywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"


def text_of(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def spaced_words(text: Column) -> Column:
    """Runs of anything but white space, in order."""
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def hashed_ngrams(words: str, bins: int) -> Column:
    """Bins of all single words and word pairs of the array column ``words``."""
    w = F.col(words)
    one = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(bins)).cast("int"))
    two = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
        lambda x, i: F.pmod(F.xxhash64(x, F.get(w, i + 1)), F.lit(bins)).cast("int"),
    )
    return F.concat(one, two)


def hashed_words(words: str, bins: int) -> Column:
    return F.transform(F.col(words), lambda x: F.pmod(F.xxhash64(x), F.lit(bins)).cast("int"))


def table(values: list[float]) -> Column:
    """A constant array; its size must be bounded by a parameter."""
    return F.split(F.lit(",".join(f"{v:.6g}" for v in values)), ",").cast("array<double>")


def summed(bins: str, values: list[float]) -> Column:
    """Sum of ``values`` over the bins of an array column, repeats included."""
    w = table(values)
    return F.aggregate(F.col(bins), F.lit(0.0), lambda s, b: s + F.get(w, b))


def labelled_sample(labels: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """At most ``rows`` labelled documents, one label each, chosen by a hash of the id, ready to broadcast."""
    usable = labels.dropna(subset=["doc_id", *columns]).groupBy("doc_id").agg(*[F.max(c).alias(c) for c in columns])
    return F.broadcast(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
