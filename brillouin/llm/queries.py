"""Queries of the corpus operators: opN_<name>(spark, sf_dir) over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vector_queries
from .embedding_join import near_vectors
from .jaccard_join import jaccard_components
from .line_dedup import dedup_lines
from .mixing import mix_sources
from .packing import pack_sequences
from .quality import rate_quality
from .shared import table
from .sharding import shard_records
from .token_counts import count_tokens
from .toxicity import score_toxicity
from .wrapper import extract_text


def op1_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_epsilon_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op3_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_records(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=24)


def op4_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"), keep=("page_id", "url"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary_file=public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_words", "n_tokens")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = rate_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rated.drop("text")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=4, threshold=(85, 100))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op10_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_sequences(table(spark, sf_dir, "documents"), tokenizer=public_tokenizers.path("word_bpe_49k.json"))


_OP5_SQL = r"""
WITH sized AS (
  SELECT *, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS closing
  FROM documents),
drawn AS (
  SELECT doc_id, source, text, size,
         -ln((CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
           / (1 + CASE WHEN size >= 50 THEN 1 ELSE 0 END + CASE WHEN length(text) BETWEEN 4 * size AND 12 * size THEN 1 ELSE 0 END
              + CASE WHEN right(closing, 1) IN ('.', '!', '?') THEN 1 ELSE 0 END) AS draw
  FROM sized),
total AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
  FROM drawn GROUP BY source),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS DOUBLE) / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM total
  WINDOW before AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), weight * max(level) OVER ()) AS target FROM levels),
ordered AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target) AS BIGINT) // t.source_size ELSE 0 END AS epochs,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size, d.text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM drawn d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM ordered
"""

_OP9_SQL = """
WITH line AS (
  SELECT doc_id, i, part,
         translate(trim(part, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM line WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT l.doc_id, l.i, l.part, r.key IS NOT NULL AND l.doc_id <> r.keeper AS gone FROM line l LEFT JOIN repeated r ON l.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(part, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


_OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
near AS (SELECT a.vec_id AS src, b.vec_id AS dst FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9),
reach(src, dst) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.src, n.dst FROM reach r JOIN near n ON r.dst = n.src),
label AS (SELECT src AS vec_id, min(dst) AS component_id FROM reach GROUP BY src)
SELECT e.vec_id, CAST((SELECT count(*) FROM near WHERE src = e.vec_id) AS BIGINT) AS n_links, component_id, component_id = e.vec_id AS kept
FROM embeddings e JOIN label USING (vec_id)
"""

_OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 4 THEN list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))
                                      WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS s FROM w),
size AS (SELECT doc_id, count(s) AS n FROM w LEFT JOIN shingle USING (doc_id) GROUP BY doc_id),
overlap AS (SELECT a.doc_id AS src, b.doc_id AS dst, count(*) AS k FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
near AS (SELECT src, dst FROM overlap JOIN size x ON x.doc_id = src JOIN size y ON y.doc_id = dst WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach(src, dst) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.src, n.dst FROM reach r JOIN near n ON r.dst = n.src)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, min(r.dst) AS component_id FROM size s JOIN reach r ON r.src = s.doc_id GROUP BY ALL
"""

_OP3_SQL = """
WITH crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_of),
raw AS (
  SELECT doc_id, coalesce('k' || CAST(doc_id AS VARCHAR), '') AS key,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes
  FROM documents),
hashed AS (
  SELECT doc_id, key, CAST(len(bytes) + 8 AS BIGINT) AS size,
         CAST(xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, crc_of[(xor(c, x) & 255) + 1])), 4294967295) AS BIGINT) AS text_crc32,
         list_transform(range(25), lambda s: CAST('0x' || substr(md5('0:' || s || ':' || key), 1, 13) AS BIGINT)) AS draws
  FROM raw, crc_table),
placed AS (
  SELECT doc_id, size, text_crc32, list_position(draws, list_max(draws[1:24])) - 1 AS shard, list_position(draws, list_max(draws)) - 1 AS grown_shard,
         CAST('0x' || substr(md5('slot:' || key || ':' || size || ':' || text_crc32), 1, 13) AS BIGINT) AS place
  FROM hashed)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INT) AS shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY place, doc_id, size, text_crc32) - 1 AS BIGINT) AS slot, CAST(grown_shard AS INT) AS grown_shard
FROM placed
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_kneser_ney_toxicity, op2_epsilon_grid_join, op3_rendezvous_shards, op4_wrapper_text, op5_mix_sources, op6_unigram_counts, op7_quality_rules, op8_jaccard_join, op9_line_dedup, op10_pack_windows, *vector_queries.QUERIES)}


def oracle_sql() -> dict[str, str]:
    return {"op2_epsilon_grid_join": _OP2_SQL, "op3_rendezvous_shards": _OP3_SQL, "op5_mix_sources": _OP5_SQL, "op8_jaccard_join": _OP8_SQL, "op9_line_dedup": _OP9_SQL} | vector_queries.SQL
