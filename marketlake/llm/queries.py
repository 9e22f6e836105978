"""The numbered queries over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import common


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.url_filter import url_filter

    return url_filter(common.table(spark, sf_dir, "pages"), RULES)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm import pii

    found = pii.find(common.table(spark, sf_dir, "documents"))
    base = pii.joined(F.col("base"))
    return found.select("doc_id", *[f"n_{k}" for k in pii.BASE], F.sha2(F.encode(base, "UTF-8"), 256).alias("base_sha256"), pii.joined(F.concat("base", "added")).alias("spans"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.chat import format_chats

    return format_chats(common.table(spark, sf_dir, "conversations"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.exact_dedup import exact_dedup

    return exact_dedup(common.table(spark, sf_dir, "documents"), keep="largest")


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.mixing import mix_sources

    return mix_sources(common.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12))::BIGINT AS h,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3 + 1)::DOUBLE AS weight,
             source_size * 3.0::DOUBLE AS cap FROM s),
x AS (SELECT *, cap / weight AS r,
  (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0.0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0)) AS x
  FROM w WINDOW b AS (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(x, r) AS level FROM x WHERE x * weight <= cap),
t AS (SELECT source, source_size, least(cap, coalesce(level * weight, cap)) AS target FROM x, l),
p AS (SELECT t.*, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
q AS (SELECT d.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
             sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             sum(size) OVER (PARTITION BY d.source, h) AS here
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN whole < 3 AND upto - rest <= rest - (upto - here) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM q
""".replace(' COLLATE "C"', "")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.packing import pack

    return pack(common.table(spark, sf_dir, "documents"), tokenizer_path(), 2048)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.ngram_join import near_duplicates

    return near_duplicates(common.table(spark, sf_dir, "documents"), 5, 75)


OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
p AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM p a JOIN p b ON a.x = b.x AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, t.b FROM reach r JOIN both_ways t ON r.b = t.a)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, c.component_id
FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id
"""


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.quality_classifier import quality_classifier

    return quality_classifier(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.lm_scoring import score

    return score(common.table(spark, sf_dir, "documents"), tokenizer_path())


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.quality_rules import quality_rules

    return quality_rules(common.table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.whitening import whiten

    return whiten(common.table(spark, sf_dir, "embeddings"), 32)


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.licenses import scan_licenses

    return scan_licenses(common.table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.alignment import align

    return align(common.table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_url_filter, op2_pii, op3_exact_dedup, op4_mixing, op5_packing, op6_ngram_join, op7_chat, op8_quality_classifier, op9_lm_scoring, op10_quality_rules, op11_whitening, op12_licenses, op13_alignment)}


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": OP3_SQL, "op4_mixing": OP4_SQL, "op6_ngram_join": OP6_SQL}
