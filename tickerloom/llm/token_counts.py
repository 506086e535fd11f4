"""Exact token counts for every context limit from one length histogram.

Documents are aggregated by encoded length; everything else is a suffix sum over the
histogram, whose rows number at most the longest document's tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import batches, documents, prefix_sums, stored
from tickerloom.llm.tokens import encoder, public_files

_LENGTHS = pa.schema([("tokens", pa.int64())])


def encoded_lengths(docs: DataFrame, files: tuple[str, str] | None = None) -> DataFrame:
    """``tokens`` of every row's whole text; NULL and empty texts have 0."""
    vocabulary, ranks = files or public_files()

    def lengths(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(((len(encoder(vocabulary, ranks).ids_bytes(text.as_py())) // 4,)
                            for batch in stream for text in batch.column(0)), _LENGTHS)

    return documents(docs).select("text").mapInArrow(lengths, "tokens long")


def length_histogram(docs: DataFrame, files: tuple[str, str] | None = None) -> DataFrame:
    """(tokens, docs): how many documents have each encoded length."""
    return encoded_lengths(docs, files).groupBy("tokens").agg(F.count(F.lit(1)).alias("docs"))


def token_counts(docs: DataFrame, files: tuple[str, str] | None = None) -> DataFrame:
    """One row per distinct length L, answering every question about the limit L.

    docs: documents of exactly L tokens; docs_at_most, docs_longer: their numbers at or below
    and above L; tokens_at_most: total tokens of the documents not longer than L (what a filter
    at L keeps); truncated_total: sum of min(length, L) (what truncation at L keeps);
    total_docs, total_tokens: of all documents; quantile: docs_at_most / total_docs, so the
    smallest L whose quantile reaches q is the exact q-quantile. A limit between two lengths
    has the row of the length below it, plus docs_longer for every token of distance. Repeated
    rows count repeatedly; an empty table gives no rows.
    """
    histogram = stored(length_histogram(docs, files), "length-histogram")
    # Lengths are dense small integers, so they serve as their own ordinal.
    sums = prefix_sums(
        histogram.withColumn("_tokens", F.col("tokens") * F.col("docs")),
        "tokens", "docs", "_docs_below")
    sums = prefix_sums(sums, "tokens", "_tokens", "_tokens_below")
    # One row of two sums.
    totals = histogram.agg(F.coalesce(F.sum("docs"), F.lit(0)),
                           F.coalesce(F.sum(F.col("tokens") * F.col("docs")), F.lit(0))).first()
    total_docs, total_tokens = (F.lit(n).cast("long") for n in totals)
    at_most = F.col("_docs_below") + F.col("docs")
    longer = total_docs - at_most
    tokens_at_most = F.col("_tokens_below") + F.col("_tokens")
    return sums.select("tokens", "docs", at_most.alias("docs_at_most"), longer.alias("docs_longer"),
                       tokens_at_most.alias("tokens_at_most"),
                       (tokens_at_most + longer * F.col("tokens")).alias("truncated_total"),
                       total_docs.alias("total_docs"), total_tokens.alias("total_tokens"),
                       (at_most / total_docs).alias("quantile"))


def truncated_total(counts: DataFrame, limit: int) -> DataFrame:
    """Tokens kept when every document is truncated to ``limit``, from ``token_counts``."""
    at = F.when(F.col("tokens") <= limit, F.col("tokens"))
    found = counts.agg(F.max(at).alias("at"), F.max("total_docs").alias("all_docs"),
                       F.max_by("truncated_total", at).alias("kept"),
                       F.max_by("docs_longer", at).alias("longer"))
    return found.select(
        F.lit(limit).alias("limit"),
        F.when(F.col("at").isNull(), F.coalesce("all_docs", F.lit(0)) * limit)
        .otherwise(F.col("kept") + F.col("longer") * (F.lit(limit) - F.col("at")))
        .cast("long").alias("truncated_total"))


def quantile(counts: DataFrame, q: float) -> DataFrame:
    """Smallest length that at least a share ``q`` of the documents does not exceed."""
    return counts.filter(F.col("quantile") >= q).agg(F.min("tokens").alias("tokens"))
