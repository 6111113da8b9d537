"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolake.llm import (
    ann,
    archive,
    bpe,
    chat,
    jaccard,
    language,
    near_vectors,
    negatives,
    packing,
    quality,
    structure,
    toxicity,
    wrapper,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The path of a vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return packing.pack_documents(documents, vocabulary("byte_bpe_50k.json"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.links(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive.convert_pages(_table(spark, sf_dir, "pages"))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language.held_out("doc_id", 3, 1)
    model = language.train(documents.filter(~held_out))
    found = language.identify(documents.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_table(spark, sf_dir, "documents"), words=4, percent=85)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = language.held_out("doc_id", 5, 0)
    model = toxicity.train(documents, labels.filter(~held_out))
    found = toxicity.score(documents, model, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings")
    return ann.search(table, table.filter(F.col("vec_id") % 100 == 0), k=10)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(documents, ranks).select("doc_id", "ids"), ranks)
    digits = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(digits, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # A conversation whose texts hold the marks of the template and a backslash.
    marks = F.lit("\\### Assistant: </turn> ok")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        marks.alias("text"),
    )
    return chat.formatted_digests(turns.unionByName(own))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(_table(spark, sf_dir, "pages"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    held_out = language.held_out("doc_id", 4, 2)
    model = quality.train(documents, labels.filter(~held_out))
    found = quality.score(documents, model, threshold=0.7, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return structure.reports(structure.damaged(turns), turns.select("conv_id"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table.withColumn("label", moved), F.col("vec_id") % 100 == 0)


_OP9 = r"""
WITH turns AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), ''))
           AS loss_sha256,
       sum(length('### ' || role || ': </turn>.')
           + length(regexp_replace(text, '([\\#<:])', '.\1', 'g')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

#: The least (cost, audit, text) by last role after each row; CRC-32 by a table of bytes.
_OP12 = r"""
WITH RECURSIVE bits(i, c, step) AS (
    SELECT i, i, 0 FROM range(256) r(i)
    UNION ALL
    SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, step + 1
    FROM bits WHERE step < 8
), names AS (
    SELECT DISTINCT coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
    FROM conversations
), crc(name, pos, c) AS (
    SELECT name, 0, 4294967295 FROM names
    UNION ALL
    SELECT crc.name, pos + 1, xor(crc.c // 256, bits.c)
    FROM crc JOIN bits ON step = 8 AND i = xor(crc.c % 256, ascii(substr(crc.name, pos + 1, 1)))
    WHERE pos < length(crc.name)
), kinds AS (
    SELECT name, xor(c, 4294967295) % 20 AS kind FROM crc WHERE pos = length(name)
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
           CASE WHEN kind = 1 THEN ''
                WHEN kind = 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g')
                ELSE coalesce(text, ' ') END AS text
    FROM conversations
    JOIN kinds ON name = coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')
    JOIN range(2) copies(copy) ON kind <> 0 AND (copy = 0 OR kind = 3)
), placed AS (
    SELECT *, substr(role, 1, 1) AS g, 
           rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text))
               AS i
    FROM damaged
), faulty AS (
    SELECT *, cut = '' AS blank,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
           right(cut, 1) NOT IN ('.', '!', '?') AS open,
           coalesce(lag(g) OVER (PARTITION BY conv_id ORDER BY i) || g NOT IN ('su', 'ua', 'au'),
                    FALSE) AS illegal
    FROM placed
), coded AS (
    SELECT conv_id, i, role || ':' || text || chr(10) AS line, text || chr(10) AS body, g,
           NOT blank AND NOT seen AS stays, (open AND NOT blank AND NOT seen)::INT AS extra
    FROM faulty
), walk(conv_id, i, n, s, u, a) AS (
    SELECT DISTINCT conv_id, 0::BIGINT, {'c': 0, 'e': '', 't': ''}, {'c': 9999999, 'e': '', 't': ''},
           {'c': 2, 'e': 'I', 't': 'user:' || chr(10)},
           {'c': 4, 'e': 'II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)}
    FROM coded
    UNION ALL
    SELECT conv_id, i, n, s, v,
           list_min([a, {'c': v.c + 2, 'e': v.e || 'I', 't': v.t || 'assistant:' || chr(10)}])
    FROM (
        SELECT conv_id, i, n, s, a,
               list_min([u] || [{'c': x.c + 2, 'e': x.e || 'I', 't': x.t || 'user:' || chr(10)}
                                FOR x IN [n, s, a]]) AS v
        FROM (
            SELECT w.conv_id, r.i,
                   {'c': n.c + 3, 'e': n.e || 'D', 't': n.t} AS n,
                   list_min([{'c': s.c + 3, 'e': s.e || 'D', 't': s.t}]
                     || [{'c': x.c + extra, 'e': x.e || 'K', 't': x.t || line}
                         FOR x IN [n] IF stays AND g = 's']) AS s,
                   list_min([{'c': u.c + 3, 'e': u.e || 'D', 't': u.t}]
                     || [{'c': x.c + extra, 'e': x.e || 'K', 't': x.t || line}
                         FOR x IN [n, s, a] IF stays AND g = 'u']
                     || [{'c': x.c + 2 + extra, 'e': x.e || 'R', 't': x.t || 'user:' || body}
                         FOR x IN [n, s, a] IF stays]) AS u,
                   list_min([{'c': a.c + 3, 'e': a.e || 'D', 't': a.t}]
                     || [{'c': x.c + extra, 'e': x.e || 'K', 't': x.t || line}
                         FOR x IN [u] IF stays AND g = 'a']
                     || [{'c': x.c + 2 + extra, 'e': x.e || 'R', 't': x.t || 'assistant:' || body}
                         FOR x IN [u] IF stays]) AS a
            FROM walk w JOIN coded r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
        )
    )
), ends AS (
    SELECT conv_id, arg_max(list_min([n, a]), i) AS best FROM walk GROUP BY conv_id
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (seen AND NOT blank) AS duplicate,
           count(*) FILTER (open AND NOT blank AND NOT seen) AS truncated,
           count(*) FILTER (illegal) AS illegal
    FROM faulty GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.e, '') AS audit,
       sha256(coalesce(left(best.t, length(best.t) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""

_OP13 = """
WITH moved AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           list_inner_product(a.v, b.v)::BIGINT AS score
    FROM moved a JOIN moved b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INT
           AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


def queries() -> dict[str, Query]:
    return {
        "op1_packing": op1_packing,
        "op2_embedding_near_dedup": op2_embedding_near_dedup,
        "op3_warc": op3_warc,
        "op4_language_id": op4_language_id,
        "op5_ngram_jaccard": op5_ngram_jaccard,
        "op6_toxicity": op6_toxicity,
        "op7_nearest_neighbours": op7_nearest_neighbours,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_chat_format": op9_chat_format,
        "op10_html_extraction": op10_html_extraction,
        "op11_quality": op11_quality,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express on whole tables."""
    return {
        "op9_chat_format": _OP9,
        "op12_conversation_repair": _OP12,
        "op13_hard_negatives": _OP13,
    }
