"""Each operator over its whole table, with the settings a production run would use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import fresh_dir
from .chat_windows import chat_windows, conversation_digests
from .decontamination import find_benchmark
from .html_template import extract_main_text
from .jaccard_join import jaccard_classes
from .line_dedup import dedup_lines
from .near_vectors import link_vectors
from .packing import pack_documents
from .prefix_trie import prefix_trie, shared_history_paths
from .registry import ORACLE, QUERIES, query, table
from .resampling import importance_resample
from .secret_scan import find_secrets, secret_digests
from .sql import crc32_sql, lowered_sql
from .token_counts import count_tokens
from .storage import stored
from .token_shards import read_shards, write_shards
from .tokens import vocabulary_path
from .toxicity import score_toxicity

__all__ = ["ORACLE", "QUERIES"]


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), 1024)


@query("op7_token_shards")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "token-shards")
    write_shards(table(spark, sf_dir, "documents"), path, vocabulary_path("word_bpe_49k.json"), end_id=1)
    return read_shards(spark, path)


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"), end_id=0, capacity=2048)


LINE_DEDUP = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS number
  FROM documents),
keyed AS (
  SELECT doc_id, line, number,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
repeated AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) <> max(doc_id)),
flagged AS (
  SELECT doc_id, number, line, r.key IS NOT NULL AND doc_id <> keeper AS gone FROM keyed LEFT JOIN repeated r USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY number) FILTER (NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id"""


@query("op10_line_dedup", LINE_DEDUP)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"), min_chars=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM sets s JOIN reach r ON s.doc_id = r.a GROUP BY s.doc_id, len(s.s)"""


@query("op8_jaccard_join", JACCARD)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"), words=4, percent=85)


@query("op6_benchmark_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), words=5, threshold=0.8)


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    scored = score_toxicity(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        max_labelled=20_000,
        learn_from="crc32(cast(doc_id as string)) % 5 <> 0",
    )
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


LINKED_VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN counted USING (vec_id)"""


@query("op1_embedding_near_dedup", LINKED_VECTORS)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"), cosine=0.93)


CHAT = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
out AS (
  SELECT *, replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '|', '&#124;') AS text_out,
         replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '|', '&#124;') AS role_out,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM turns),
sized AS (
  SELECT *, (strlen(text_out) + 3) // 4 + 4 AS tokens, place = 1 AND role = 'system' AS is_system,
         11 + length(text_out) + length(role_out) AS chars FROM out),
line AS (
  SELECT *, sum(CASE WHEN is_system THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS system,
         sum(CASE WHEN is_system THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY place) AS ends FROM sized),
placed AS (
  SELECT *, ends - tokens AS starts, greatest(1, greatest(1, 2048 - system) - least(512, greatest(1, 2048 - system) // 4)) AS piece
  FROM line WHERE NOT is_system),
body AS (
  SELECT *, 2 * (starts // piece) + CAST((ends - 1) // piece > starts // piece AS INTEGER) AS win FROM placed),
spans AS (SELECT conv_id, win, min(starts) AS s, greatest(0, least(512, 2048 - any_value(system) - sum(tokens))) AS reach FROM body GROUP BY ALL),
formatted AS (
  SELECT conv_id, chars FROM body
  UNION ALL SELECT s.conv_id, chars FROM spans s JOIN line l ON s.conv_id = l.conv_id AND l.is_system
  UNION ALL SELECT l.conv_id, chars FROM line l WHERE is_system AND conv_id NOT IN (SELECT conv_id FROM spans)
  UNION ALL SELECT b.conv_id, chars FROM body b JOIN spans s
    ON b.conv_id = s.conv_id AND b.ends <= s.s AND b.starts >= s.s - s.reach),
total AS (SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM formatted GROUP BY 1)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(length(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       any_value(formatted_chars) AS formatted_chars, CAST(0 AS BIGINT) AS n_over_budget
FROM sized JOIN total USING (conv_id) GROUP BY conv_id"""


@query("op5_chat_windows", CHAT)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long"), "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    windows = chat_windows(turns.unionByName(probe), budget=2048, history=512)
    return conversation_digests(stored(windows, "chat-windows"), budget=2048)


@query("op3_html_main_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


RESAMPLING = f"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all({lowered_sql("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM documents),
wanted AS (
  SELECT unnest(regexp_extract_all({lowered_sql("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark),
known AS (SELECT w, {crc32_sql("w")} % 10000 AS bucket FROM (SELECT w FROM words UNION SELECT w FROM wanted)),
have AS (SELECT bucket, count(*) AS s FROM words JOIN known USING (w) GROUP BY 1),
want AS (SELECT bucket, count(*) AS t FROM wanted JOIN known USING (w) GROUP BY 1),
gains AS (
  SELECT bucket, floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * ((SELECT count(*) FROM words) + 10000.0::DOUBLE)
           / ((CAST(coalesce(s, 0) AS DOUBLE) + 1) * ((SELECT count(*) FROM wanted) + 10000.0::DOUBLE)))) AS gain
  FROM have FULL JOIN want USING (bucket)),
weights AS (
  SELECT doc_id, count(*) AS n_features, sum(gain) AS weight FROM words JOIN known USING (w) JOIN gains USING (bucket) GROUP BY 1),
scores AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
              / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights USING (doc_id)),
places AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scores LEFT JOIN places USING (doc_id)
"""


@query("op13_importance_resampling", RESAMPLING)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, least_words=20).drop("n_words")


TRIE = f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT i.conv_id, place, role, text FROM ids i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 5 WHERE place <= h
  UNION ALL SELECT conv_id, place, role, text FROM ids JOIN turns USING (conv_id) WHERE place > h),
paths AS (
  SELECT conv_id, row_number() OVER begins AS depth, strlen(text) AS size,
         string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER begins AS path
  FROM rebuilt WINDOW begins AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
members AS (
  SELECT conv_id, depth, size, min(conv_id) OVER (PARTITION BY depth, path) AS node, max(depth) OVER (PARTITION BY conv_id) = depth AS ends
  FROM paths),
nodes AS (
  SELECT node, depth, any_value(size) AS size, count(*) AS n,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ids FROM members GROUP BY ALL),
linked AS (
  SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN members p ON p.conv_id = n.node AND p.depth = n.depth - 1),
families AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS children FROM linked WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT l.*, coalesce(children, 0) AS children FROM linked l LEFT JOIN families USING (node, depth)),
subtrees AS (
  SELECT a.node, a.depth, count(*) FILTER (c.children = 0) AS leaves, sum((c.n - 1) * c.size) AS saved
  FROM counted c JOIN members a ON a.conv_id = c.node AND a.depth <= c.depth GROUP BY ALL)
SELECT node AS conv_id, CAST(depth AS BIGINT) AS depth, parent AS parent_conv_id, n AS n_convs, CAST(children AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(ids) AS ends_sha256
FROM counted JOIN subtrees USING (node, depth)
"""


@query("op12_conversation_trie", TRIE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(shared_history_paths(table(spark, sf_dir, "conversations"), family=5, longest=9))


@query("op11_secret_scan")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(find_secrets(table(spark, sf_dir, "documents")))
