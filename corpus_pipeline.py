"""The training-data pipeline: quality rules, line dedup, near-dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared work folder and reads it for the next one.
All stages but the last return the columns of documents. Null and empty texts
fail the quality rules; an empty table goes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from argent.llm.bpe import bpe_round_trip
from argent.llm.line_dedup import line_dedup
from argent.llm.minhash import drop_near_duplicates
from argent.llm.mixing import mix
from argent.llm.quality_rules import quality_rules
from argent.session import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that fail the line rules."""
    out = quality_rules(docs.select(*COLUMNS)).where("kept").withColumn("text", F.col("clean_text"))
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later occurrences of three-line windows."""
    out = line_dedup(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8)."""
    return drop_near_duplicates(docs.select(*COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mix(docs.select(*COLUMNS))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Token ids of each document, their number, and digests of ids and decoded text.

    The executors come here with the memory of four stages, so a task remembers
    a third of what it may."""
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    out = bpe_round_trip(docs.select("doc_id", "lang", "source", "text"), vocabulary, chunks=30_000, words=60_000, with_text=False)
    return out.select("doc_id", "lang", "source", F.size("token_ids").cast("bigint").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("bpe_tokens", token_stage),
]

#: SQL has no way to express MinHash candidates and BPE merges; tests/llm checks
#: each stage's own result and holds the tokens against the library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
