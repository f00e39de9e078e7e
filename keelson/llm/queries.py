"""Queries of the training-data operators, each over its whole table, with equivalent SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import (alignment, byte_bpe, decontaminate, fingerprint, interaction, jaccard, katz, language, neighbours, packing, quality,
                         token_files, url_filter)

# fixed by the query's definition
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))


def op4_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(table(spark, sf_dir, "documents"), order=3)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.through_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf_dir, "documents"), words=3, numerator=90, denominator=100)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.rules_frame(spark, URL_RULES))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_documents(table(spark, sf_dir, "documents"))


def op10_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[0]


def op11_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), words=10)
    names = F.sort_array(F.transform("item_ids", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "spans")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model")).documents


OP8_SQL = """
WITH rules(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
rests AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host,
                  regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM rests),
lowered AS (SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parsed),
fitting AS (SELECT p.page_id, r.host || r.path AS rule, r.verdict,
                   row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS rn
            FROM lowered p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM lowered p LEFT JOIN fitting f ON p.page_id = f.page_id AND f.rn = 1
"""

OP11_SQL = """
WITH split AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                      regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
failures AS (SELECT part, doc_id, (len(words) < 100)::INT AS a, (100 * len(list_distinct(words)) < 80 * len(words))::INT AS b,
                    (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t))::INT AS c,
                    regexp_matches(t, '[#$%&*|]')::INT AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS e FROM split),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
patterns AS (SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS pattern, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
             FROM failures LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (SELECT v.f || w.f || x.f || y.f || z.f AS filter_order, [v.bit, w.bit, x.bit, y.bit, z.bit] AS bits
           FROM letters v JOIN letters w ON w.f <> v.f JOIN letters x ON x.f NOT IN (v.f, w.f) JOIN letters y ON y.f NOT IN (v.f, w.f, x.f)
                JOIN letters z ON z.f NOT IN (v.f, w.f, x.f, y.f)),
steps AS (SELECT filter_order, s.step, bits[s.step] AS bit, coalesce(list_sum(bits[1:s.step - 1]), 0)::INT AS before
          FROM orders CROSS JOIN (SELECT unnest(range(1, 6))::INT AS step) s),
counted AS (SELECT part, filter_order, step, bit,
                   sum(n * (pattern & (before + bit) = 0)::INT)::BIGINT AS kept,
                   sum(n * (pattern & before = 0 AND pattern & bit > 0)::INT)::BIGINT AS removed,
                   sum(n * (pattern & before > 0 AND pattern & bit > 0)::INT)::BIGINT AS redundant,
                   sum(n * (pattern = bit)::INT)::BIGINT AS unique_fails,
                   sum(good * (pattern & before = 0 AND pattern & bit > 0)::INT)::BIGINT AS good_lost,
                   sum(toxic * (pattern & before = 0 AND pattern & bit > 0)::INT)::BIGINT AS toxic_lost
            FROM patterns CROSS JOIN steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM counted
"""

REGISTRY = {
    "op1_nearest_neighbours": (op1_nearest_neighbours, None),
    "op2_packing": (op2_packing, None),
    "op3_order_minhash": (op3_order_minhash, None),
    "op4_katz_backoff": (op4_katz_backoff, None),
    "op5_token_files": (op5_token_files, None),
    "op6_jaccard_join": (op6_jaccard_join, None),
    "op7_byte_bpe": (op7_byte_bpe, None),
    "op8_url_filter": (op8_url_filter, OP8_SQL),
    "op9_language_id": (op9_language_id, None),
    "op10_quality_resampling": (op10_quality_resampling, None),
    "op11_filter_interaction": (op11_filter_interaction, OP11_SQL),
    "op12_decontamination": (op12_decontamination, None),
    "op13_tokenizer_alignment": (op13_tokenizer_alignment, None),
}


def queries() -> dict:
    return {name: query for name, (query, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql}
