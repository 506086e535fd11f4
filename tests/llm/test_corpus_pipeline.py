"""The pipeline on a planted corpus, and the registered queries on the smallest tables."""

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


def text(seed, n=80):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(3000)}" for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """100 clean documents, copies, near copies, leaks, toxic and private ones."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    clean = [(n, text(n)) for n in range(200)]
    copies = [(1000 + n, text(n)) for n in range(10)]
    near = [(1100 + n, text(n).replace(" ", "  ")) for n in range(10, 20)]
    item = text(5000, 30)
    leaked = [(1200 + n, f"{text(6000 + n, 50)} {item.upper()} {text(7000 + n, 50)}") for n in range(5)]
    toxic = [(1300 + n, f"{text(8000 + n, 40)} vilest dreadfulness {text(9000 + n, 40)}") for n in range(120)]
    private = [(1500, f"{text(9999)} 4785380592391139 end")]
    odd = [(1600, None), (1601, "")]
    rows = [(d, t, "en", "src", len(t or "")) for d, t in clean + copies + near + leaked + toxic + private + odd]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{folder}/documents.parquet")
    labels = [(d, 1, int(1300 <= d < 1420)) for d, *_ in rows if d < 200 or 1300 <= d < 1420]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_every_stage_takes_effect(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, planted)
        assert docs.columns == columns and docs.dtypes == spark.read.parquet(f"{planted}/documents.parquet").dtypes
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    everything = {r.doc_id for r in spark.read.parquet(f"{planted}/documents.parquet").collect()}
    assert everything - set(kept["toxicity"]) == set(range(1300, 1420))
    assert set(kept["toxicity"]) - set(kept["near_duplicates"]) == {*range(1000, 1010), *range(1110, 1120)}
    assert set(kept["near_duplicates"]) - set(kept["decontamination"]) == set(range(1200, 1205))
    assert set(kept["pii"]) == {*range(200), 1500, 1600, 1601}
    assert "4785380592391139" not in kept["pii"][1500] and kept["pii"][7] == text(7)


def test_the_whole_run(spark, planted):
    rows = corpus_pipeline.run(spark, planted)
    assert {r.doc_id for r in rows.select("doc_id").distinct().collect()} == {*range(200), 1500, 1600, 1601}
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_no_documents(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs_next = stage(spark, docs, planted)
        assert docs_next.count() == 0
        docs = docs_next if "text" in docs_next.columns else docs


def test_repeated_ids_and_extra_columns(spark, planted):
    rows = [(1, text(1), "a", 1), (1, text(1), "a", 1), (2, text(1), "b", 1), (None, text(3), "c", 1), (None, None, "d", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cls string, component_id int")
    out = corpus_pipeline.near_duplicates(spark, docs, planted)
    assert out.columns == docs.columns
    assert sorted(r.cls for r in out.collect()) == ["a", "c", "d"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no provided tables here")
@pytest.mark.parametrize("name", sorted(n for n in queries() if n.startswith("op") or n == "pipeline"))
def test_registered_queries_cover_their_table(spark, name):
    rows = queries()[name](spark, SF)
    ids = {"op7": ("conv_id", "conversations", 1), "op10": ("page_id", "pages", 0), "op13": ("page_id", "pages", 0)}
    column, table, more = ids.get(name.split("_")[0], ("doc_id", "documents", 0))
    if name.startswith(("op3", "op5", "op11", "pipeline")):
        assert rows.count() > 0
        return
    whole = spark.read.parquet(f"{SF}/{table}.parquet").select(column).distinct().count()
    assert rows.select(column).distinct().count() == whole + more
