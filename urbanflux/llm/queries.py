"""One query per operator of this subpackage over the given tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflux.llm import bpe, licenses, lm, minhash, mixing, neighbours, ordinal, pii, prefix_trie, quality, spelling, suffixes, url_rules
from urbanflux.llm.common import read
from urbanflux.session import materialize

Query = Callable[[SparkSession, str], DataFrame]


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "keeper")


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "method_rule")


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = lm.learn_vocabulary(documents)
    tokens = lm.tokenise(documents, vocabulary)
    return lm.score_tokens(tokens, lm.fit(tokens, vocabulary))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(documents, pii.train(documents))
    counts = [pii.count_of(F.col("base_spans"), kind).alias(f"n_{kind}") for kind in pii.KINDS]
    base = F.sha2(pii.joined(F.col("base_spans")), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"), columns=["doc_id"])


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan_licenses(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.drop("text", "hits")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", ordinal.grades_of(F.col("quality"), F.col("toxic")).alias("grade"))
    graded = ordinal.grade_documents(documents, ordinal.fit(documents, labels, grades=3))
    return graded.select("doc_id", "expected_grade", F.col("tails")[0].alias("p_1"), F.col("tails")[1].alias("p_2"), "selected")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    sizes = materialize(documents.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "sizes")
    mixed = mixing.mix(sizes, size=F.col("size"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(read(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_minhash": op2_minhash,
    "op3_url_rules": op3_url_rules,
    "op4_lm": op4_lm,
    "op5_pii": op5_pii,
    "op6_quality": op6_quality,
    "op7_licenses": op7_licenses,
    "op8_neighbours": op8_neighbours,
    "op9_ordinal": op9_ordinal,
    "op10_mixing": op10_mixing,
    "op11_suffixes": op11_suffixes,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling": op13_spelling,
}

_URL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), split AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM parts
), rules(verdict, rule, host, path) AS (VALUES
  ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
  ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
  ('block', 'com/de/', 'com', '/de/')
), urls AS (SELECT DISTINCT host, path FROM split
), best AS (
  SELECT u.host, u.path, arg_min(r.rule, (-length(r.rule), r.rule)) AS rule,
    arg_min(r.verdict, (-length(r.rule), r.rule)) AS verdict
  FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY ALL
), patterns AS (
  SELECT host, path, CASE
    WHEN regexp_matches(host || path, '^(?:[^/]*[.-])?spam-farm\.') THEN 'spam farm'
    WHEN regexp_matches(host || path, '^(?:[^/]*\.)?adserver\.') THEN 'ad server'
    WHEN regexp_matches(host || path, '^[^/]+/(?:[^/]+/)*login(?:[./]|$)') THEN 'login page'
    WHEN regexp_matches(host || path, '^[^/]+/(?:[^/]+/)*wp-admin(?:/|$)') THEN 'admin page'
    WHEN regexp_matches(host || path, '^[^/]+/(?:[^/]+/)*cart/(?:checkout|add)(?:/|$)') THEN 'shopping cart'
    END AS method_rule FROM urls
)
SELECT s.page_id, s.host, s.path, b.rule,
  coalesce(b.verdict, CASE WHEN p.method_rule IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, p.method_rule
FROM split s LEFT JOIN best b USING (host, path) LEFT JOIN patterns p USING (host, path)
"""

_MIX = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
    coalesce('=' || source, '') AS source_key, 3 * source_size AS cap FROM totals
), ordered AS (SELECT *, cap / weight AS ratio FROM weighed
), levels AS (
  SELECT *, (sum(source_size) OVER ()
      - coalesce(sum(cap) OVER (ORDER BY ratio, source_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT
    / sum(weight) OVER (ORDER BY ratio, source_key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ordered
), chosen AS (SELECT arg_min(level, (ratio, source_key)) AS level FROM levels WHERE level <= ratio
), goals AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce(c.level, ratio) * weight) AS target FROM levels, chosen c
), placed AS (
  SELECT doc_id, size, source_size, target, sum(size) OVER (PARTITION BY d.source
      ORDER BY md5(coalesce(doc_id::VARCHAR, 'null')), size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  list_sum([greatest(0, least(start + e * source_size + size, round(target)) - (start + e * source_size))
    FOR e IN [0, 1, 2]])::BIGINT AS taken
FROM placed
"""

ORACLE: dict[str, str] = {"op3_url_rules": _URL, "op10_mixing": _MIX}
