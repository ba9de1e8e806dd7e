"""The registered queries of this folder, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.llm import alignment, bpe, circulant, conversations, decontaminate, html_text, pii, quality, simhash, suffix_dedup, topk, toxicity, warc
from pulseboard.plans.registry import Query

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
windows AS (
    SELECT item_id, 13 AS size, array_to_string(ws[i:i + 12], ' ') AS gram
    FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM b WHERE len(ws) >= 13)
    UNION ALL SELECT item_id, len(ws), array_to_string(ws, ' ') FROM b WHERE len(ws) BETWEEN 1 AND 12),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
    SELECT doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') AS gram
    FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, sizes WHERE len(ws) >= size)),
hits AS (SELECT doc_id, i, size, item_id FROM grams JOIN windows USING (size, gram)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN items t USING (doc_id)
"""

SUFFIX_DEDUP_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
starts AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(n - 49)) AS p FROM d WHERE n >= 50)),
first AS (SELECT s, min(doc_id) AS id FROM starts GROUP BY s HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT doc_id, p FROM starts JOIN first USING (s) WHERE id < doc_id),
bytes AS (SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS b FROM (SELECT doc_id, h, unnest(range(n)) AS p FROM d)),
marked AS (
    SELECT b.doc_id, b.p, b.b, max(x.p) OVER (PARTITION BY b.doc_id ORDER BY b.p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
    FROM bytes b LEFT JOIN hits x ON x.doc_id = b.doc_id AND x.p = b.p),
edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS opens FROM marked),
cut AS (SELECT doc_id, sum(gone::INT) AS n_removed, sum(opens::INT) AS n_spans,
               coalesce(string_agg(b, '' ORDER BY p) FILTER (WHERE NOT gone), '') AS kept FROM edges GROUP BY doc_id)
SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
q AS (SELECT page_id, strlen(body) AS n, sha256(body) AS digest, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM q
"""

TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::HUGEINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS near, q.v AS a, c.v AS b
           FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
exact AS (SELECT query_id, vec_id, CASE WHEN list_dot_product(list_transform(a, lambda x: abs(x)::DOUBLE), list_transform(b, lambda x: abs(x)::DOUBLE)) < 9007199254740992
                 THEN near::BIGINT ELSE list_sum(list_transform(range(1, len(a) + 1), lambda i: a[i] * b[i]))::BIGINT END AS score FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM exact) WHERE rank <= 20
"""

#: crc32 by bits; one row per state and conversation goes through the rows by recursion, the least of the cheapest edits is kept.
CONVERSATIONS_SQL = r"""
WITH RECURSIVE original AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS mark FROM conversations),
fated AS (
    SELECT *, xor(list_reduce(
        flatten(list_transform(range(octet_length(mark)), lambda i: [('0x' || hex(mark)[2 * i + 1:2 * i + 2])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, 4294967295::BIGINT), 4294967295) % 20 AS fate
    FROM original),
copied AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM fated),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS shown FROM copied),
judged AS (
    SELECT *, left(role, 1) AS sign, CASE WHEN shown = '' THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
inserts(p, k, state, lead) AS (
    VALUES (0, 0, 0, ''), (1, 0, 1, ''), (2, 0, 2, ''), (3, 0, 3, ''),
           (0, 1, 2, chr(10) || 'user:'), (1, 1, 2, chr(10) || 'user:'), (2, 1, 3, chr(10) || 'assistant:'), (3, 1, 2, chr(10) || 'user:'),
           (0, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:'),
           (2, 2, 2, chr(10) || 'assistant:' || chr(10) || 'user:'), (3, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:')),
edits(state, edit, sign, q, cost, role) AS (
    VALUES (0, 'D', NULL, 0, 3, NULL), (1, 'D', NULL, 1, 3, NULL), (2, 'D', NULL, 2, 3, NULL), (3, 'D', NULL, 3, 3, NULL),
           (0, 'R', NULL, 2, 2, 'user'), (1, 'R', NULL, 2, 2, 'user'), (2, 'R', NULL, 3, 2, 'assistant'), (3, 'R', NULL, 2, 2, 'user'),
           (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (2, 'K', 'a', 3, 0, NULL), (3, 'K', 'u', 2, 0, NULL)),
ways AS (
    SELECT p, q, edit, sign, role, lead, 2 * k + cost AS cost, repeat('I', k) || edit AS audit FROM inserts JOIN edits USING (state)),
solved AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS body FROM conversations
    UNION ALL
    SELECT conv_id, i, state, cost, audit, body FROM (
        SELECT s.conv_id, r.i, w.q AS state, s.cost + w.cost + (r.fault = 'truncated' AND w.edit <> 'D')::INT AS cost, s.audit || w.audit AS audit,
               s.body || w.lead || CASE w.edit WHEN 'D' THEN '' ELSE chr(10) || coalesce(w.role, r.role) || ':' || r.text END AS body
        FROM solved s JOIN judged r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1
        JOIN ways w ON w.p = s.state AND (w.edit = 'D' OR r.fault NOT IN ('blank', 'duplicate')) AND (w.edit <> 'K' OR w.sign = r.sign))
    QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1),
facts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (i > 1 AND before || sign NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
ended AS (
    SELECT s.conv_id, s.cost + f.cost AS cost, s.audit || f.audit AS audit, s.body || f.lead AS body
    FROM solved s LEFT JOIN facts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id
    JOIN (VALUES (0, 0, '', ''), (1, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 2, 'I', chr(10) || 'assistant:'), (3, 0, '', '')) f(state, cost, audit, lead)
      ON f.state = s.state
    WHERE s.i = coalesce(c.n, 0)
    QUALIFY row_number() OVER (PARTITION BY s.conv_id ORDER BY s.cost + f.cost, s.audit || f.audit) = 1)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, e.cost::BIGINT AS cost, audit, sha256(substr(body, 2)) AS repaired_sha256
FROM ended e LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.cut_documents(_table(spark, folder, "documents")).drop("kept")


def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_pages(_table(spark, folder, "pages"))


def warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(_table(spark, folder, "pages")).drop("url")


def tokenizer(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[bytes, str]:
    """Rank file content and splitting pattern of a public tokenizer."""
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN


def byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return docs.select("doc_id", bpe.encode(F.col("text"), *tokenizer(), digest=True).alias("e")).select("doc_id", "e.*")


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_documents(_table(spark, folder, "documents"))


def quality_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_documents(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def toxicity_kernel(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_documents(_table(spark, folder, "documents"), vocabularies())


def vocabularies() -> alignment.Vocabularies:
    """The files of two public tokenizers."""
    import public_tokenizers

    return alignment.read_vocabularies(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repaired(_table(spark, folder, "conversations"))


def circulant_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return circulant.near_duplicates(_table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {q.name: q for q in (
    Query("op1_decontamination", decontamination, DECONTAMINATION_SQL),
    Query("op2_suffix_array_dedup", suffix_array_dedup, SUFFIX_DEDUP_SQL),
    Query("op3_html_extraction", html_extraction, None),
    Query("op4_warc", warc_archives, WARC_SQL),
    Query("op5_byte_level_bpe", byte_level_bpe, None),
    Query("op6_pii", personal_data, None),
    Query("op7_quality", quality_ranking, None),
    Query("op8_exact_topk", exact_topk, TOPK_SQL),
    Query("op9_toxicity", toxicity_kernel, None),
    Query("op10_simhash_near_duplicates", simhash_near_duplicates, None),
    Query("op11_cross_tokenizer_alignment", cross_tokenizer_alignment, None),
    Query("op12_conversation_repair", conversation_repair, CONVERSATIONS_SQL),
    Query("op13_circulant_minhash", circulant_near_duplicates, None),
)}
