"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.base import QUERIES, SQL, query, table, tokenizer_file
from millrace.llm.decontam import find_items
from millrace.llm.feast import whiten
from millrace.llm.four_russians import hard_negatives
from millrace.llm.hmm_lm import score_documents
from millrace.llm.minmax_dedup import near_duplicates
from millrace.llm.mixing import mix_sources
from millrace.llm.token_counts import count_tokens
from millrace.llm.top_k import top_k
from millrace.llm.url_rules import judge_urls
from millrace.llm.vp_tree import nearest
from millrace.llm.warc_zip import archive_pages
from millrace.llm.zstd_language import identify_languages
from millrace.llm.wavelet import token_digest

__all__ = ["QUERIES", "SQL"]

OP9_SQL = r"""
WITH split AS (
  SELECT page_id, coalesce(url, '') AS url,
         CASE WHEN contains(url, '://') THEN
           translate(regexp_extract(url, '://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN regexp_extract(url, '://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(host, path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fitting AS (
  SELECT s.page_id, s.host, s.path, max({'n': length(r.host || r.path), 'rule': r.host || r.path,
                                         'verdict': r.verdict}) AS best
  FROM split s JOIN rules r
    ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
  GROUP BY ALL),
judged AS (
  SELECT s.*, f.best,
    CASE WHEN regexp_matches(lower(url), '[?&]utm_source=feed([&#]|$)') THEN 'feed-tracking'
         WHEN regexp_matches(lower(url), '[?&](php)?sessid=') THEN 'session-id'
         WHEN regexp_matches(lower(url), '/wp-login\.php([?#]|$)') THEN 'login'
         WHEN regexp_matches(lower(url), '\.zip([?#]|$)') THEN 'archive-file'
         WHEN regexp_matches(lower(url), '\.exe([?#]|$)') THEN 'program-file'
         WHEN contains(lower(url), '/ads/') THEN 'ad-path' END AS hit
  FROM split s LEFT JOIN fitting f USING (page_id, host, path))
SELECT page_id, host, path, best.rule AS rule,
       CASE WHEN best IS NOT NULL THEN best.verdict WHEN hit IS NULL THEN 'allow' ELSE 'block' END AS verdict,
       CASE WHEN best IS NULL THEN hit END AS pattern
FROM judged
"""


OP8_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, length(text) AS chars,
         (('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, '?' || md5(coalesce(text, '')))), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u
  FROM documents),
keyed AS (
  SELECT doc_id, source, size,
         -ln(u) / CASE WHEN chars / nullif(size, 0)::DOUBLE BETWEEN 3 AND 12 THEN 1.0 ELSE 0.5 END AS key FROM sized),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM keyed GROUP BY source),
weighted AS (
  SELECT *, ((place - 1) % 3 + 1)::DOUBLE AS w, source_size * 3.0::DOUBLE AS cap,
         sum(source_size) OVER ()::DOUBLE AS total FROM totals),
shares AS (
  SELECT *, total - coalesce(sum(cap) OVER (ORDER BY cap / w, place
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (ORDER BY cap / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight FROM weighted),
capped AS (SELECT *, cap * weight <= rest * w AS capped FROM shares),
targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap ELSE (total - coalesce(sum(cap) FILTER (capped) OVER (), 0))
              / sum(w) FILTER (NOT capped) OVER () * w END AS target FROM capped),
plan AS (SELECT *, least(coalesce(floor(target / nullif(source_size, 0)), 0), 3) AS epochs FROM targets),
placed AS (
  SELECT k.*, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS budget,
         row_number() OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size) AS step, dense_rank() OVER (ORDER BY k.source NULLS LAST) AS s
  FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source),
walk AS (
  SELECT s, 0::BIGINT AS step, max(budget) AS rest, false AS took FROM placed GROUP BY s
  UNION ALL
  SELECT w.s, p.step, w.rest - CASE WHEN p.size > 0 AND p.size <= w.rest THEN p.size ELSE 0 END,
         p.size > 0 AND p.size <= w.rest
  FROM walk w JOIN placed p ON p.s = w.s AND p.step = w.step + 1),
drawn AS (SELECT p.*, w.took AS drawn FROM placed p JOIN walk w ON w.s = p.s AND w.step = p.step),
gaps AS (
  SELECT *, budget - coalesce(sum(size) FILTER (drawn) OVER (PARTITION BY source), 0) AS gap FROM drawn),
fillers AS (
  SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY abs(gap - size), key) AS n FROM gaps
  WHERE NOT drawn AND size > 0 AND abs(gap - size) < gap),
counted AS (
  SELECT g.*, CASE WHEN size > 0 THEN (epochs + (drawn OR f.doc_id IS NOT NULL)::INT)::BIGINT ELSE 0 END AS copies
  FROM gaps g LEFT JOIN fillers f ON f.doc_id = g.doc_id AND f.n = 1)
SELECT doc_id, size::BIGINT AS size, source_size, target, (copies * size)::BIGINT AS taken, copies::BIGINT AS copies
FROM counted
"""


@query("op8_mix_sources", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


@query("op9_url_rules", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query("op6_wavelet_tokens")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@query("op7_decontaminate")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN first < d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < d.page_id THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""


@query("op5_warc_zip", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


@query("op4_zstd_language")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


@query("op2_hmm_lm")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


OP1_SQL = """
WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op1_exact_top_k", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


@query("op3_minmax_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH v AS (SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
             AND len([x FOR x IN embedding IF x <> 0]) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op11_vp_tree", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


OP12_SQL = """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v,
                  CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
             list_dot_product(a.v, c.v)::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10
"""


@query("op12_four_russians", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved))


@query("op13_feast_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
