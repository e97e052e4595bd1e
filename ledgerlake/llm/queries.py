"""Registered queries of the training-data operators (production parameters,
whole tables) and their DuckDB counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (
    chat_repair,
    decontaminate,
    embedding_codes,
    hard_negatives,
    hpy_model,
    line_runs,
    near_duplicates,
    quality_ledger,
    secret_scan,
    sentencepiece_codec,
    spelling_variants,
    toxicity,
    url_rules,
)
from ledgerlake.llm.common import table

#: Rules of the URL filter: (host/path, verdict).
URL_RULES = [
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
    ("com/fr/", "allow"), ("com/de/", "block"),
]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.line_digests(table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair(table(spark, sf_dir, "conversations"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_digests(
        table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classify(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality_ledger
    rows = q.ledger(table(spark, sf_dir, "documents"))
    bits = rows["failed_rules"]
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        q.rejects(bits, q.BASE).alias("base_failed"), (~q.rejects(bits)).alias("kept"), "failed_rules")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpy_model.score(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_codes.link(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_secret_scan, op2_line_dedup, op3_chat_formatting, op4_sentencepiece, op5_toxicity, op6_near_dedup, op7_url_filter, op8_quality_rules, op9_lm_scoring,
        op10_decontamination, op11_spelling_variants, op12_embedding_dedup, op13_hard_negatives)
}
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_RULES = ", ".join(f"('{r}', '{v}')" for r, v in URL_RULES)

ORACLES: dict[str, str] = {
    "op7_url_filter": f"""
WITH p AS (
  SELECT row_number() OVER () AS rid, page_id,
    translate(coalesce(regexp_extract(url, '{_URL}', 1), ''), '{url_rules.UPPER}', '{url_rules.LOWER}') AS host,
    coalesce(regexp_extract(url, '{_URL}', 2), '') AS path
  FROM pages),
r(rule, verdict) AS (VALUES {_RULES}),
m AS (
  SELECT rid, rule, verdict, row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC, verdict DESC) AS k
  FROM p JOIN r ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, strpos(rule, '/'))))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT rid, rule, verdict FROM m WHERE k = 1) b USING (rid)""",
    "op8_quality_rules": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
win AS (
  SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS h
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
hit AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, h) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM hit, range(8) AS t(k) GROUP BY rid),
ls AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w USING (rid) JOIN ls USING (rid) LEFT JOIN cov USING (rid)),
b AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 20 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 32 ELSE 0 END)::BIGINT AS failed_rules
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed, failed_rules = 0 AS kept, failed_rules
FROM b""",
}
