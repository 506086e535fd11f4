"""Five stages from raw documents to packed sequences; part of the subpackage ``llm``.

Each stage takes (spark, docs, sf_dir) and gets all that its predecessor kept. All but the
last return the columns of documents. NULL texts stay NULL up to the PII stage, which, as
packing does, reads them as empty; an empty table passes through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm.common import read, sparing, stored
from tickerloom.llm.decontaminate import without_leaks
from tickerloom.llm.ngram_join import Rule, linked_documents
from tickerloom.llm.packing import pack
from tickerloom.llm.pii import pseudonymize, session_key
from tickerloom.llm.toxicity import THRESHOLD, fit, score

#: Five-word shingles, similarity of 0.8 or more.
NEAR_DUPLICATES = Rule(words=5, share=80)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score, learned from the labels of those at hand, is below 0.7."""
    sparing(spark)      # before the first Python worker starts, for all stages
    model = fit(docs, read(spark, sf_dir, "labels"))
    # The text passes through Python once; whether it was NULL goes with the other columns.
    more = [F.col(name) for name in docs.columns if name not in ("doc_id", "text")]
    others = F.struct(F.col("text").isNull().alias("absent"), F.col("doc_id").alias("id"),
                      (F.struct(*more) if more else F.lit(0)).alias("row"))
    scored = score(docs.select("doc_id", "text", others.alias("others")), model, ("others",), with_text=True)
    own = {"doc_id": F.col("others.id"), "text": F.when(~F.col("others.absent"), F.col("text"))}
    return scored.filter(F.col("score") < THRESHOLD).select(
        *[own.get(name, F.col(f"others.row.{name}")).alias(name) for name in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of similar documents: the one with the smallest id.

    Documents without words are linked with nothing and stay. Rows equal in id and text are
    copies; rows of one id with different texts each stay where their id names a component.
    """
    kept = (linked_documents(docs, NEAR_DUPLICATES).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")))
    kept = stored(kept, "representatives")

    def rows_of(ids: DataFrame) -> DataFrame:
        return docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")

    # An id in several rows: its equal texts are copies of each other as well.
    repeated = rows_of(kept.filter("rows > 1")).dropDuplicates(["doc_id", "text"])
    return rows_of(kept.filter("rows = 1")).unionByName(repeated)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, read(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal values; ``n_chars`` follows the text."""
    others = [name for name in docs.columns if name not in ("doc_id", "text")]
    replaced = pseudonymize(docs, session_key(spark), carry=tuple(others))
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return replaced.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2048 tokens."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]

#: A trained classifier and a tokenizer decide, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again by the next one."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
