"""A corpus cleaned in five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written to the shared
folder as Parquet and read again as the next stage's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import decontamination, line_dedup, quality, sentencepiece_codec, simhash
from arrears.llm.batches import read
from arrears.llm.catalog import coded_digests, piece_model
from arrears.sources.staging import keep, scope

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.kept_documents(docs, read(spark, sf_dir, "labels"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages go from all documents but the first; one that was nothing else goes whole.

    ``n_chars`` follows the text. Documents that came without text stay.
    """
    found = line_dedup.without_repeated_lines(docs)
    kept = found.where((F.col("n_deleted_words") == 0) | (F.trim("text") != ""))
    changed = F.col("n_deleted_words") > 0
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.char_length("text").cast(kind)
        kept = kept.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component stays."""
    return simhash.one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digests of every remaining document's pieces and of what they decode to."""
    return coded_digests(sentencepiece_codec.encode_decode(docs, piece_model()))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", repeated_passages),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_free),
    ("sentencepiece", encoded),
]

# Hashed n-gram models, patience alignment and piece encoding have no SQL form; the tests
# hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages before have written is removed on the way."""
    docs = read(spark, sf_dir, "documents")
    with scope(spark):
        for _, step in STAGES[:-1]:
            with scope(spark):
                docs = keep(step(spark, docs, sf_dir))
        return keep(STAGES[-1][1](spark, docs, sf_dir))
