"""Queries of the operators for URLs, vector codes and clusters, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .clustering import cluster_vectors
from .code_compression import compress_vectors
from .link_trust import LINK, filter_urls
from .shared import table

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
ROUNDS = 20


def op11_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), RULES, rounds=ROUNDS)


def op12_cover_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(table(spark, sf_dir, "embeddings"), entries=256, rounds=4, scale=1024)


def op13_filtered_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"), dims=64, clusters=40, rounds=5, scale=256, seed="2")


_RANK = """
r{k} AS MATERIALIZED (
  SELECT host, sum(trust) AS trust, sum(distrust) AS distrust
  FROM (SELECT host, floor(trust * (1 - 0.85::DOUBLE)) AS trust, floor(distrust * (1 - 0.85::DOUBLE)) AS distrust FROM r0
        UNION ALL SELECT dst, floor(trust * t), floor(distrust * d) FROM r{before} JOIN flow ON host = src)
  GROUP BY host HAVING sum(trust) + sum(distrust) > 0)"""

OP11_SQL = (
    r"""
WITH page AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         list_transform(coalesce(regexp_extract_all(html, '{LINK}', 1), []), lambda h: translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS linked
  FROM pages),
judged AS (
  SELECT *, row_number() OVER () AS n,
         CASE WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
              WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
              WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
              WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
              WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/' END AS rule
  FROM page),
ruled AS (SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS by_rule FROM judged),
r0 AS MATERIALIZED (
  SELECT host, count(*) FILTER (WHERE by_rule = 'allow') * 1048576::DOUBLE AS trust, count(*) FILTER (WHERE by_rule = 'block') * 1048576::DOUBLE AS distrust
  FROM ruled WHERE by_rule IS NOT NULL GROUP BY host),
link AS (
  SELECT host AS src, dst, count(*) AS w FROM (SELECT DISTINCT n, host, unnest(linked) AS dst FROM judged WHERE host <> '') WHERE dst <> host GROUP BY ALL),
ways AS (
  SELECT src, dst, sum(t) AS t, sum(d) AS d FROM (SELECT src, dst, w AS t, 0 AS d FROM link UNION ALL SELECT dst, src, 0, w FROM link) GROUP BY ALL),
given AS (SELECT src, sum(t) AS t, sum(d) AS d FROM ways GROUP BY src),
flow AS MATERIALIZED (
  SELECT src, dst, CASE WHEN g.t > 0 THEN 0.85::DOUBLE * CAST(b.t AS DOUBLE) / CAST(g.t AS DOUBLE) ELSE 0 END AS t,
         CASE WHEN g.d > 0 THEN 0.85::DOUBLE * CAST(b.d AS DOUBLE) / CAST(g.d AS DOUBLE) ELSE 0 END AS d
  FROM ways b JOIN given g USING (src)),""".replace("{LINK}", LINK.replace("'", "''"))
    + ",".join(_RANK.format(k=k, before=k - 1) for k in range(1, ROUNDS + 1))
    + f"""
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(coalesce(trust, 0) AS BIGINT) AS trust, CAST(coalesce(distrust, 0) AS BIGINT) AS distrust
FROM ruled LEFT JOIN r{ROUNDS} USING (host)
"""
)

# squared distances of whole numbers below 2^53 are exact in doubles
_FAR = "list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x)"

_MOVED = """
a{k} AS MATERIALIZED (
  SELECT v.row, v.part, v.x, arg_min(c.entry, struct_pack(far := {far}, entry := c.entry)) AS entry, min({far}) AS far
  FROM v JOIN c{k} c ON v.part = c.part GROUP BY ALL){more}"""

_MEANS = """,
c{after} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(m.x, c.x) AS x
  FROM c{k} c LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY i) AS x
    FROM (SELECT part, entry, i, floor(sum(y) / count(*)) AS mean
          FROM (SELECT part, entry, unnest(x) AS y, unnest(range(1, len(x) + 1)) AS i FROM a{k}) GROUP BY ALL)
    GROUP BY ALL) m USING (part, entry)),"""


def _lloyd(rounds: int) -> str:
    """a0, c1, a1, ... from v (row, part, x) and c0 (part, entry, x)."""
    return "".join(_MOVED.format(k=k, far=_FAR, more=_MEANS.format(k=k, after=k + 1) if k < rounds else "") for k in range(rounds + 1))


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0"

OP12_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS row, list_transform(embedding, lambda e: floor(1024 * CAST(e AS DOUBLE))) AS x
  FROM embeddings WHERE {_FINITE}),
v AS MATERIALIZED (SELECT row, part, x[part * len(x) // 4 + 1:(part + 1) * len(x) // 4] AS x FROM kept, (SELECT unnest(range(4)) AS part)),
c0 AS MATERIALIZED (SELECT part, row - 1 AS entry, x FROM v WHERE row <= 256),{_lloyd(4)},
coded AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM a4 GROUP BY row),
digest AS (SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, i)) AS codebooks_sha256
           FROM (SELECT part, entry, unnest(x) AS y, unnest(range(1, len(x) + 1)) AS i FROM c4))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (row), digest
"""

OP13_SQL = f"""
WITH kept AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)), vec_id) AS row, list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS x
  FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
v AS MATERIALIZED (SELECT row, 0 AS part, x FROM kept),
c0 AS MATERIALIZED (SELECT part, row - 1 AS entry, x FROM v WHERE row <= 40),{_lloyd(5)},
digest AS (SELECT entry, sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
           FROM (SELECT entry, unnest(x) AS y, unnest(range(1, len(x) + 1)) AS i FROM c5) GROUP BY entry)
SELECT vec_id, CAST(entry AS INT) AS cluster, CAST(far AS BIGINT) AS distance, CAST(sum(far) OVER (PARTITION BY entry) AS BIGINT) AS cluster_inertia,
       CAST(sum(far) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM kept JOIN a5 USING (row) JOIN digest USING (entry)
"""

QUERIES = (op11_link_trust, op12_cover_tree_codes, op13_filtered_clusters)
SQL = {"op11_link_trust": OP11_SQL, "op12_cover_tree_codes": OP12_SQL, "op13_filtered_clusters": OP13_SQL}
