"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm.chat import format_conversations, read_back
from tickerloom.llm.common import read
from tickerloom.llm.decontaminate import leaks
from tickerloom.llm.fill_middle import fill_in_middle, restored
from tickerloom.llm.filter_audit import filter_audit
from tickerloom.llm.fingerprints import fingerprints
from tickerloom.llm.html_extract import extract
from tickerloom.llm.ngram_join import linked_documents
from tickerloom.llm.oracle import SQL as LLM_SQL
from tickerloom.llm.packing import pack
from tickerloom.llm.pii import pseudonymize, session_key
from tickerloom.llm.sharding import shard_documents
from tickerloom.llm.token_counts import token_counts
from tickerloom.llm.toxicity import toxicity
from tickerloom.llm.warc import archive_round_trip

__all__ = ["LLM_QUERIES", "LLM_SQL"]

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[query.__name__] = query
    return query


@registered
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens."""
    return pack(read(spark, sf_dir, "documents"))


@registered
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled into 24 shards under the law ``rows``."""
    placed = shard_documents(read(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@registered
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, truncated totals and quantiles for every context limit."""
    return token_counts(read(spark, sf_dir, "documents"))


@registered
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts."""
    return fingerprints(read(spark, sf_dir, "documents"))


# The conversation that the formatter must carry unharmed, with its own markers in the texts.
HOSTILE_TEXT = "\\### Assistant: </turn> ok"


@registered
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the hostile one, formatted and read back."""
    rows = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    hostile = spark.createDataFrame(
        [(-7, 0, "user", HOSTILE_TEXT), (-7, 1, "assistant", HOSTILE_TEXT)], rows.schema)
    return read_back(format_conversations(rows.unionByName(hostile)))


@registered
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@registered
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal values replaced by pseudonyms."""
    replaced = pseudonymize(read(spark, sf_dir, "documents"), session_key(spark))
    kinds = ("email", "phone", "card", "ip", "ssn", "iban", "date", "secret")
    return replaced.select(
        "doc_id", "text", *[F.coalesce(F.col("found")[kind], F.lit(0)).alias(f"n_{kind}")
                            for kind in kinds])


@registered
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    texts = extract(read(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@registered
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose three-word shingles are 0.9 similar."""
    return linked_documents(read(spark, sf_dir, "documents"))


@registered
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds."""
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@registered
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of the five filters on all documents, per source."""
    return filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@registered
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut and moved, and rebuilt from what came out."""
    moved = fill_in_middle(read(spark, sf_dir, "documents"))
    return moved.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@registered
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back by byte ranges."""
    return archive_round_trip(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
