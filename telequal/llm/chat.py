"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted; adjacent turns of one role become one marked turn
whose texts stay apart by a part marker, so the original turns can be read back.

    <|start|>role\\n text [<|part|> text ...] <|end|>\\n        (without the blanks)

Inside roles and texts ``&``, ``<`` and ``[`` are written as entities (line ends too, in roles), so that no marker
of this or a bracketed template can appear there; reading undoes it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, PART, END = "<|start|>", "<|part|>", "<|end|>\n"
TEXT_ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
ROLE_ENTITIES = (*TEXT_ENTITIES, ("\n", "&#10;"))


def escaped(c: Column, entities=TEXT_ENTITIES) -> Column:
    for plain, entity in entities:
        c = F.replace(c, F.lit(plain), F.lit(entity))
    return c


def unescaped(c: Column, entities=TEXT_ENTITIES) -> Column:
    for plain, entity in reversed(entities):
        c = F.replace(c, F.lit(entity), F.lit(plain))
    return c


def formatted(turns: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``loss`` (start and end, in code points, of every text
    of the role to learn from).

    Turns are ordered by turn, then role, then text; a null turn comes first, null roles and texts are empty.
    Repeated rows are all formatted.  Rows without a conversation id form one conversation.  An empty text is a
    turn with nothing in it.  An empty table gives an empty result; other columns are ignored.
    """
    conv = turns.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("turn"),
                    F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"),
                )
            )
        ).alias("_turns")
    )
    t = F.col("_turns")
    conv = conv.withColumn(
        "_firsts",
        F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"])),
    )
    f = F.col("_firsts")
    conv = conv.withColumn(
        "_merged",
        F.transform(
            f,
            lambda i, k: F.struct(
                F.get(t, i)["role"].alias("role"),
                F.transform(
                    F.slice(t, i + 1, F.coalesce(F.get(f, k + 1), F.size(t)) - i), lambda x: escaped(x["text"])
                ).alias("parts"),
            ),
        ),
    )
    # Pieces in order: markers, and texts with whether they are learned from.
    pieces = F.flatten(
        F.transform(
            "_merged",
            lambda m: F.concat(
                F.flatten(
                    F.transform(
                        m["parts"],
                        lambda p, k: F.array(
                            F.struct(
                                F.when(k == 0, F.concat(F.lit(START), escaped(m["role"], ROLE_ENTITIES), F.lit("\n")))
                                .otherwise(F.lit(PART))
                                .alias("piece"),
                                F.lit(False).alias("learn"),
                            ),
                            F.struct(p.alias("piece"), (m["role"] == learn_from).alias("learn")),
                        ),
                    )
                ),
                F.array(F.struct(F.lit(END).alias("piece"), F.lit(False).alias("learn"))),
            ),
        )
    )
    conv = conv.withColumn("_pieces", pieces)
    spans = F.aggregate(
        "_pieces",
        F.struct(
            F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("spans")
        ),
        lambda done, p: F.struct(
            (done["at"] + F.length(p["piece"])).alias("at"),
            F.when(
                p["learn"],
                F.concat(
                    done["spans"],
                    F.array(
                        F.struct(done["at"].alias("start"), (done["at"] + F.length(p["piece"])).alias("end"))
                    ),
                ),
            )
            .otherwise(done["spans"])
            .alias("spans"),
        ),
        lambda done: done["spans"],
    )
    return conv.select(
        "conv_id",
        F.array_join(F.transform("_pieces", lambda p: p["piece"]), "").alias("formatted"),
        spans.alias("loss"),
    )


def read_turns(text: str = "formatted") -> Column:
    """The original turns (role, text) of a formatted conversation."""
    marked = F.filter(F.split(F.col(text), "<\\|end\\|>\n"), lambda x: x != "")
    return F.flatten(
        F.transform(
            marked,
            lambda m: F.transform(
                F.split(F.substr(m, F.locate("\n", m) + 1), "<\\|part\\|>"),
                lambda p: F.struct(
                    unescaped(F.substr(m, F.lit(len(START) + 1), F.locate("\n", m) - len(START) - 1), ROLE_ENTITIES).alias(
                        "role"
                    ),
                    unescaped(p).alias("text"),
                ),
            ),
        )
    )


def read_loss(text: str = "formatted", spans: str = "loss") -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(
        F.transform(spans, lambda s: unescaped(F.substr(F.col(text), s["start"] + 1, s["end"] - s["start"]))), ""
    )
