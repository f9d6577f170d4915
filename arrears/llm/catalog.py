"""Every corpus operator as a query over its whole table, with its settings in use."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import (
    chat_format,
    collocations,
    decontamination,
    fingerprints,
    language_id,
    line_dedup,
    mixing,
    quality,
    sentencepiece_codec,
    sharding,
    simhash,
    token_counts,
    vector_codes,
)
from arrears.llm.batches import read

Query = Callable[[SparkSession, str], DataFrame]

PIECE_MODEL = "piece_bpe_32k.model"
TEMPLATE_CASE = "</s>[INST] ok [/INST]"  # a conversation of control strings, id -1


def piece_model(name: str = PIECE_MODEL) -> bytes:
    """The content of a public model file; its name or path is the caller's to choose."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes()


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"), shards=16)


def coded_digests(coded: DataFrame) -> DataFrame:
    """Token count and digests of ids and decoded text, of what the codec returns."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        # The spans tile the source: the last one ends with it.
        (F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)) == F.col("n_bytes")).alias("spans_cover"),
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_codec.encode_decode(read(spark, sf_dir, "documents"), piece_model())
    return coded_digests(coded)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeated_lines(
        read(spark, sf_dir, "documents").select("doc_id", "text")
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(read(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), piece_model(), limit=4096)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )
    items = F.array_sort(F.array_distinct(F.col("matches.item_id")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    case = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TEMPLATE_CASE).alias("text"),
    )
    windows = chat_format.chat_windows(conversations.unionByName(case), piece_model())
    return chat_format.read_back(windows)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(read(spark, sf_dir, "documents")).taken()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_line_dedup": op3_line_dedup,
    "op4_language_id": op4_language_id,
    "op5_fingerprints": op5_fingerprints,
    "op6_token_counts": op6_token_counts,
    "op7_decontamination": op7_decontamination,
    "op8_chat_format": op8_chat_format,
    "op9_quality": op9_quality,
    "op10_simhash": op10_simhash,
    "op11_collocations": op11_collocations,
    "op12_mixing": op12_mixing,
    "op13_vector_codes": op13_vector_codes,
}

# Word 13-grams of every document against those of every item, joined as text.
DECONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, size, array_to_string(w[k:k + size - 1], ' ') AS gram
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS k
        FROM (SELECT *, least(13, len(w)) AS size FROM b) WHERE size > 0)),
places AS (
  SELECT doc_id, size, k, array_to_string(w[k:k + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k
        FROM d, (SELECT DISTINCT size FROM grams) WHERE len(w) >= size)),
found AS (SELECT doc_id, k, size, item_id FROM places JOIN grams USING (size, gram)),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS listed
  FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

SQL: dict[str, str] = {"op7_decontamination": DECONTAMINATION_SQL}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
