"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat, dedup, jaccard, licenses, packing, pieces, quality, repair, simhash, tokenfiles, warc, whitening
from tidemark.llm.shared import read_table
from tidemark.sources.scratch import scratch_path, settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
CONTROL_TURN = r"\### Assistant: </turn> ok"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark)
    manifest = tokenfiles.write(read_table(spark, sf_dir, "documents"), WORD_TOKENIZER, end=2, folder=folder)
    return tokenfiles.read(manifest, folder).withColumnRenamed("id", "doc_id")


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    found = quality.judged(docs, read_table(spark, sf_dir, "labels"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return found.select(F.col("row.doc_id").alias("doc_id"), *names)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), WORD_TOKENIZER, end=1)


@query
def op5_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_counts(read_table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


@query
def op6_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), WORD_TOKENIZER)


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write(read_table(spark, sf_dir, "pages"), scratch_path(spark))
    found = settle(warc.read(manifest, payloads=False), scratch_path(spark)).where("reason IS NULL")
    written = manifest.agg(F.sum("records")).first()[0] or 0
    read, responses, payloads = found.agg(
        F.count(F.lit(1)),
        F.count_if(F.col("record_type") == "response"),
        F.count_distinct("payload_digest"),
    ).first()
    if read != written:
        raise ValueError(f"{read} of {written} records could be read")
    if responses != payloads:
        raise ValueError(f"{payloads} payloads are in {responses} response records")
    return found.select(
        F.col("page").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


@query
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TURN), (-7, 1, "assistant", CONTROL_TURN)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    formatted = chat.format_chats(turns.unionByName(control), BYTE_TOKENIZER)
    return chat.digests(settle(formatted, scratch_path(spark)), BYTE_TOKENIZER)


@query
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read_table(spark, sf_dir, "documents")).drop("spans")


@query
def op10_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup.exact_duplicates(docs).select(
        F.col("row.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256"
    )


@query
def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("bigint"))


@query
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    return repair.with_absent(repair.repair_conversations(repair.damaged(turns)), turns)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


SQL["op10_content_sort"] = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (same ORDER BY doc_id) = 1 AS kept, sha256(content) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents)
WINDOW same AS (PARTITION BY content)
"""

# Five bytes are ten hexadecimal digits and eight letters of base 32.
SQL["op7_warc"] = r"""
WITH named AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages),
hashed AS (SELECT *, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS first FROM named),
parts AS (
  SELECT page_id, payload, first, part, CAST('0x' || substr(hex, 1 + 10 * part, 10) AS BIGINT) AS bits
  FROM hashed, (SELECT unnest(range(4)) AS part)),
letters AS (
  SELECT page_id, payload, first, 8 * part + k AS place,
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((bits >> (35 - 5 * k)) & 31 AS INTEGER) + 1, 1) AS letter
  FROM parts, (SELECT CAST(unnest(range(8)) AS INTEGER) AS k))
SELECT page_id, CAST(strlen(any_value(payload)) AS BIGINT) AS payload_bytes,
       string_agg(letter, '' ORDER BY place) AS payload_digest,
       CASE WHEN page_id = any_value(first) THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> any_value(first) THEN any_value(first) END AS refers_to
FROM letters GROUP BY page_id
"""

SQL["op8_chat"] = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL_TURN}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_TURN}'),
escaped AS (
  SELECT *, role || ': ' || text AS shown,
         length(role || '~' || text) - length(regexp_replace(role || '~' || text, '[\\]|###+', '', 'g'))
         + (length(role || '~' || text) - length(replace(role || '~' || text, '</turn>', ''))) // 7
         + (length(role || '~' || text) - length(replace(role || '~' || text, ': ', ''))) // 2 AS marks
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ') + length(shown) + marks + length('</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""
