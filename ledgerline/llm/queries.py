"""Queries of the corpus operators over the driver tables, and SQL where it can state the result."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, exact_topk, hard_negatives, mixing, packing, projection_forest, quality, repair, simhash, substring_dedup, suffix_dedup, token_files, url_filter
from .common import load, removed_at_exit, shared_folder

WORDS = "word_bpe_49k.json"
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.substring_dedup(load(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write_token_files(load(spark, sf_dir, "documents"), path, public_tokenizers.path(WORDS), end_id=1)
    removed_at_exit(spark, path)
    return token_files.documents_of(token_files.read_token_files(spark, path))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(load(spark, sf_dir, "pages"), RULES)


def op5_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_forest.nearest(load(spark, sf_dir, "embeddings"), k=10, every=100)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.suffix_dedup(load(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digest(load(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_by_inner_product(load(spark, sf_dir, "embeddings"), k=10, every=100, scale=1024)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"), words=4, bits=4)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(load(spark, sf_dir, "documents"), public_tokenizers.path(WORDS), end_id=0, capacity=2048)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", label))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(repair.damaged(load(spark, sf_dir, "conversations")), there_col="there")


def op13_budget_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_token_files": op3_token_files,
    "op4_url_filter": op4_url_filter,
    "op5_projection_forest": op5_projection_forest,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_exact_topk": op8_exact_topk,
    "op9_simhash": op9_simhash,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_budget_mix": op13_budget_mix,
}

ORACLES: dict[str, str] = {
    "op1_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        windows AS (
          SELECT doc_id, i, array_to_string(list_slice(words, i, i + 49), ' ') AS t
          FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50)
        ), least AS (SELECT t, MIN(doc_id) AS doc_id FROM windows GROUP BY t),
        hits AS (SELECT windows.doc_id, i FROM windows JOIN least ON windows.t = least.t AND least.doc_id < windows.doc_id),
        gone AS (SELECT DISTINCT doc_id, i + k AS i FROM hits, range(50) AS r(k)),
        each_word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
        kept AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS kept FROM each_word e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY 1),
        removed AS (SELECT doc_id, COUNT(*) AS n FROM gone GROUP BY 1)
        SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, COALESCE(removed.n, 0) AS n_removed, sha256(COALESCE(kept, '')) AS kept_sha256
        FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id LEFT JOIN removed ON w.doc_id = removed.doc_id
    """,
    "op6_suffix_dedup": """
        WITH d AS (SELECT doc_id, encode(COALESCE(text, '')) AS b FROM documents), n AS (SELECT *, octet_length(b) AS len FROM d),
        windows AS (SELECT doc_id, i, md5(b[i:i + 399]) AS h FROM (SELECT doc_id, b, unnest(range(1, len - 398)) AS i FROM n WHERE len >= 400)),
        twice AS (SELECT h FROM windows GROUP BY h HAVING COUNT(*) > 1),
        hits AS (SELECT doc_id, i FROM windows WHERE h IN (SELECT h FROM twice)),
        marked AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS opens FROM hits),
        numbered AS (SELECT *, SUM(opens) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
        spans AS (SELECT doc_id, span, MIN(i) AS a, MAX(i) + 400 AS z FROM numbered GROUP BY 1, 2),
        sums AS (SELECT doc_id, COUNT(*) AS n_spans, SUM(z - a) AS n_removed, MAX(z) AS z FROM spans GROUP BY 1),
        cuts AS (
          SELECT doc_id, COALESCE(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 1) AS f, a AS t FROM spans
          UNION ALL SELECT n.doc_id, COALESCE(sums.z, 1), n.len + 1 FROM n LEFT JOIN sums ON n.doc_id = sums.doc_id
        ), kept AS (SELECT c.doc_id, string_agg(hex(b[f:t - 1]), '' ORDER BY f) AS k FROM cuts c JOIN n ON c.doc_id = n.doc_id WHERE t > f GROUP BY 1)
        SELECT n.doc_id, CAST(n.len AS BIGINT) AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, CAST(COALESCE(n_spans, 0) AS BIGINT) AS n_spans,
               sha256(unhex(COALESCE(k, ''))) AS kept_sha256
        FROM n LEFT JOIN sums ON n.doc_id = sums.doc_id LEFT JOIN kept ON n.doc_id = kept.doc_id
    """,
    "op8_exact_topk": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
          FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
          SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                 CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
        ), ranked AS (
          SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op11_hard_negatives": """
        WITH v AS (
          SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
          SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
        ), positives AS (
          SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
    "op12_conversation_repair": r"""
        WITH RECURSIVE keyed AS (
          SELECT *, COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ') AS k, dense_rank() OVER (ORDER BY conv_id) AS c FROM conversations
        ), fates AS (
          SELECT c, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text, xor(4294967295, list_reduce(list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT)),
                 lambda h, b: list_reduce(range(8), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(h, b)), 4294967295)) % 20 AS fate
          FROM keyed
        ), damaged AS (
          SELECT c, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
                 CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS nth
          FROM fates WHERE fate <> 0
        ), placed AS (
          SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, nth) AS i, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last_one FROM damaged
        ), seen AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) AS again, lag(role) OVER (PARTITION BY c ORDER BY i) AS role_before FROM placed),
        marked AS (
          SELECT *, CASE WHEN last_one = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN last_one NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM seen
        ), inserts(p, q, n, put) AS (VALUES
          (0, 0, 0, ''), (0, 2, 1, 'user:\n'), (0, 3, 2, 'user:\nassistant:\n'), (1, 1, 0, ''), (1, 2, 1, 'user:\n'), (1, 3, 2, 'user:\nassistant:\n'), (2, 2, 0, ''), (2, 3, 1, 'assistant:\n'),
          (3, 3, 0, ''), (3, 2, 1, 'user:\n')
        ), edits(p, q, edit, initial, role) AS (VALUES
          (0, 0, 'D', '', ''), (1, 1, 'D', '', ''), (2, 2, 'D', '', ''), (3, 3, 'D', '', ''), (0, 1, 'K', 's', ''), (0, 2, 'K', 'u', ''), (1, 2, 'K', 'u', ''), (2, 3, 'K', 'a', ''), (3, 2, 'K', 'u', ''),
          (0, 2, 'R', '', 'user'), (1, 2, 'R', '', 'user'), (2, 3, 'R', '', 'assistant'), (3, 2, 'R', '', 'user')
        ), steps AS (
          SELECT inserts.p, edits.q, edit, initial, edits.role AS set_role, 3 * n + CASE edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END AS cost, repeat('I', n) || edit AS letters, put
          FROM inserts JOIN edits ON inserts.q = edits.p
        ), ways AS (
          SELECT DISTINCT c, CAST(0 AS BIGINT) AS i, 0 AS p, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': ''} AS best FROM keyed
          UNION ALL
          SELECT w.c, m.i, s.q, MIN({'cost': w.best.cost + s.cost + CASE WHEN fault = 'truncated' AND edit <> 'D' THEN 3 ELSE 0 END, 'audit': w.best.audit || letters,
                 'lines': w.best.lines || put || CASE edit WHEN 'D' THEN '' WHEN 'K' THEN role || ':' || text || '\n' ELSE set_role || ':' || text || '\n' END})
          FROM ways w JOIN marked m ON m.c = w.c AND m.i = w.i + 1
               JOIN steps s ON s.p = w.p AND (edit <> 'K' OR initial = left(role, 1)) AND (edit = 'D' OR fault NOT IN ('blank', 'duplicate'))
          GROUP BY w.c, m.i, s.q
        ), ends AS (
          SELECT w.c, MIN({'cost': best.cost + 3 * n, 'audit': best.audit || repeat('I', n), 'lines': best.lines || put}) AS best
          FROM ways w JOIN inserts ON inserts.p = w.p AND inserts.q IN (0, 3)
          WHERE w.i = (SELECT COALESCE(MAX(i), 0) FROM marked m WHERE m.c = w.c) GROUP BY 1
        ), counts AS (
          SELECT c, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) FILTER (fault = 'blank') AS blank, COUNT(*) FILTER (fault = 'duplicate') AS duplicate,
                 COUNT(*) FILTER (fault = 'truncated') AS truncated, COUNT(*) FILTER (i > 1 AND left(role_before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
          FROM marked GROUP BY 1
        )
        SELECT k.conv_id, COALESCE(gaps, 0) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate, COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal,
               best.cost AS cost, best.audit AS audit, sha256(CASE WHEN best.lines = '' THEN '' ELSE left(best.lines, length(best.lines) - 1) END) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id, c FROM keyed) k JOIN ends ON k.c = ends.c LEFT JOIN counts ON k.c = counts.c
    """.replace("\\n", "\n"),
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
