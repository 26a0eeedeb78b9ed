"""Queries of the text operators over their whole tables, and the SQL that checks them where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telequal.llm import chat, decontaminate, html, licenses, lines, lm, minhash, mixing, negatives, quality, repeats
from telequal.llm import toxicity, tries


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.classes(_table(spark, folder, "documents"), width=3, similarity=0.85)


def toxic(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (_table(spark, folder, t) for t in ("documents", "labels"))
    return toxicity.fit_and_score(docs, labels.where(~toxicity.in_fold(1, 3)), carry=["doc_id"]).select(
        "doc_id",
        toxicity.in_fold(1, 3).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def mixing_rates(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (_table(spark, folder, t) for t in ("documents", "labels"))
    return mixing.mixed(docs, labels, keep_text=False).select("doc_id", "tokens", "posterior", "rate", "copies")


def language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    training = "pmod(crc32(cast(cast(doc_id as string) as binary)), 7) != 2"
    return lm.scored(docs, training, every_context=True).select(
        "doc_id", (~F.expr(training)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def page_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extracted(_table(spark, folder, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    read = chat.formatted(rows.union(probe)).select(
        "conv_id", "formatted", chat.read_turns().alias("turns"), chat.read_loss().alias("learned")
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


CHAT_SQL = """
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS role_before,
           length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) AS n_text,
           length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;')) AS n_role
    FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), ''))
           AS loss_sha256,
       CAST(sum(n_text + CASE WHEN role = role_before THEN 8 ELSE 9 + n_role + 1 + 8 END) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (_table(spark, folder, t) for t in ("documents", "labels"))
    return quality.judged(docs.select("doc_id", "text"), quality.fit(docs, labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return repeats.cut_repeats(docs, keep_first=False, carry_text=False, passage=repeats.PASSAGE).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept_bytes", 256).alias("kept_sha256"),
        "passage_bytes",
        (F.col("passage_bytes") > 0).alias("has_passage"),
    )


def benchmark_matches(spark: SparkSession, folder: str) -> DataFrame:
    docs, bench = (_table(spark, folder, t) for t in ("documents", "benchmark"))
    found = decontaminate.search(docs, bench, carry=["doc_id"]).withColumn("n_hit", decontaminate.hit_words())
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "longest",
    )


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(_table(spark, folder, "documents"), carry=["doc_id"])
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])
    named = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        named(base).alias("base_labels"),
        named(F.col("places")).alias("labels"),
        F.when(F.exists("places", lambda p: ~p["base"]), 1.0).when(F.size("places") > 0, 0.5).otherwise(0.0).alias("score"),
    )


def repeated_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return lines.drop_repeated_lines(docs, min_documents=10, keep_first=False).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


LINES_SQL = """
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT uid, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT uid) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE r.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE r.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN r ON r.key = k.key GROUP BY uid, doc_id
"""


def hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), moved.alias("label"), "embedding")
    return negatives.mine(negatives.whole_vectors(rows), F.col("id") % 50 == 0)


NEGATIVES_SQL = """
WITH v AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.id AS anchor_id, v.id AS other, a.label = v.label AS alike, CAST(list_inner_product(a.vec, v.vec) AS BIGINT) AS score
    FROM v a JOIN v ON a.id <> v.id WHERE a.id % 50 = 0),
p AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return tries.prefix_trie(rows, head, F.col("conv_id") - F.col("conv_id") % 100, most_head=5)


# The checksum of a decimal number, bit by bit: every byte is mixed in (a value of 0 to 255), then eight shifts (-1).
TRIE_SQL = """
WITH t AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
           coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (
    SELECT conv_id, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
               string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda s, b: CASE WHEN b >= 0 THEN xor(s, b) WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END),
               4294967295) % 6 AS h
    FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id)),
r AS (
    SELECT c.conv_id, t.i AS part, 0 AS own, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.i <= c.h
    UNION ALL SELECT c.conv_id, t.i, 1, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, part) AS depth, role, text FROM r),
f AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY depth) AS turns FROM o GROUP BY conv_id),
g AS (SELECT c.conv_id, coalesce(f.turns, []) AS turns FROM c LEFT JOIN f USING (conv_id)),
m AS (SELECT conv_id, len(turns) AS length, unnest(generate_series(0, len(turns))) AS depth, turns FROM g),
n AS (
    SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE length = depth), '') AS ends,
           (count(*) - 1) * coalesce(any_value(length(turns[depth].t)), 0) AS cost
    FROM m GROUP BY depth, path),
k AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.depth = n.depth AND k.path = n.path)
SELECT a.conv_id, CAST(a.depth AS BIGINT) AS depth, any_value(p.conv_id) AS parent_conv_id, any_value(a.n_convs) AS n_convs,
       any_value(a.n_children) AS n_children, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves,
       CAST(sum(b.cost) AS BIGINT) AS saved_tokens, sha256(any_value(a.ends)) AS ends_sha256
FROM w a JOIN w b ON b.depth >= a.depth AND b.path[1:a.depth] = a.path
     LEFT JOIN w p ON p.depth = a.depth - 1 AND p.path = a.path[1:a.depth - 1]
GROUP BY a.depth, a.path, a.conv_id
"""


QUERIES = {
    "op1_near_duplicates": near_duplicates,
    "op2_toxicity": toxic,
    "op3_mixing": mixing_rates,
    "op4_language_model": language_model,
    "op5_page_text": page_text,
    "op6_chat_format": chat_format,
    "op7_quality_rules": quality_rules,
    "op8_repeated_passages": repeated_passages,
    "op9_benchmark_matches": benchmark_matches,
    "op10_license_scan": license_scan,
    "op11_repeated_lines": repeated_lines,
    "op12_hard_negatives": hard_negatives,
    "op13_conversation_trie": conversation_trie,
}
CHECKS = {
    "op6_chat_format": CHAT_SQL,
    "op11_repeated_lines": LINES_SQL,
    "op12_hard_negatives": NEGATIVES_SQL,
    "op13_conversation_trie": TRIE_SQL,
}
