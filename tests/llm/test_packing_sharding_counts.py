"""Packing, sharding and token counts against plain Python."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickerloom.llm.common import ordinals, prefix_sums
from tickerloom.llm.packing import pack, pattern_slots, shortest_pack_first
from tickerloom.llm.sharding import external_shuffle, scatter, shard_documents, write_shards
from tickerloom.llm.token_counts import quantile, token_counts, truncated_total
from tickerloom.llm.tokens import Encoder, public_files

TEXTS = ["", None, "plain words here", "two  spaces and\n new lines \n \n x", "tail \n ", "<|endoftext|> a <|x|>",
         "émile ç ñandú ß", "日本語 テキスト", "x" * 5000, "don't we'll 12 34.5% (ok)", "a b  c", " lead",
         "word " * 3000, "word " * 3000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, text, "en", n) for n, text in enumerate(TEXTS)]
    rows += [(None, "no id", "en", 1), (3, "same id", "en", 1), (3, "same id", "en", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, length int")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def own():
    return Encoder(*public_files())


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'<|>sdabZé0.,! 　"), st.characters(
    exclude_categories=["Cs"])), max_size=60))
def test_ids_equal_those_of_the_library(reference, own, text):
    assert own.ids_bytes(text) == ids_of(reference, text).tobytes()
    assert own.ids_bytes(text) == ids_of(reference, text).tobytes()      # from the cache


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), min_size=1))
def test_patterns_place_every_piece_once(histogram):
    patterns = shortest_pack_first(histogram, 64)
    placed = {}
    for pattern in patterns:
        assert sum(size * n for size, n in pattern.slots) <= 64
        for size, n in pattern.slots:
            placed[size] = placed.get(size, 0) + n * pattern.count
    assert placed == histogram
    ranks = {}
    for size, rank, many, each, _, _ in pattern_slots(patterns):
        assert rank == ranks.get(size, 0) and many % each == 0
        ranks[size] = rank + many
    assert ranks == histogram


@pytest.mark.parametrize("length", [7, 2048])
def test_every_id_lies_in_one_piece(docs, reference, length):
    rows = pack(docs, length).toPandas()
    want = [np.append(ids_of(reference, t or ""), np.uint32(1)) for t in [*TEXTS, "no id", "same id", "same id"]]
    assert rows.length.sum() == sum(map(len, want))
    found = rows[~rows.doc_id.isin([3])].dropna(subset=["doc_id"]).sort_values(["doc_id", "start"])
    for doc, pieces in found.groupby("doc_id"):
        ids, at = want[int(doc)], 0
        for piece in pieces.itertuples():
            assert piece.start == at and piece.doc_tokens == len(ids)
            assert piece.ids_crc32 == zlib.crc32(ids[at:at + piece.length].astype("<u4").tobytes())
            at += piece.length
        assert at == len(ids)
    for _, own in rows.sort_values("offset").groupby("sequence_id"):
        assert (own.offset == own.length.cumsum() - own.length).all() and own.length.sum() <= length
    assert sorted(rows.sequence_id.unique()) == list(range(rows.sequence_id.nunique()))


def test_nothing_to_pack(docs):
    assert pack(docs.limit(0)).collect() == []
    assert token_counts(docs.limit(0)).collect() == []
    assert shard_documents(docs.limit(0)).collect() == []


def test_counts_answer_every_limit(docs, reference):
    lengths = [len(ids_of(reference, t or "")) for t in [*TEXTS, "no id", "same id", "same id"]]
    counts = token_counts(docs)
    for row in counts.collect():
        limit = row.tokens
        assert row.docs == lengths.count(limit)
        assert row.docs_longer == sum(n > limit for n in lengths)
        assert row.tokens_at_most == sum(n for n in lengths if n <= limit)
        assert row.truncated_total == sum(min(n, limit) for n in lengths)
        assert (row.total_docs, row.total_tokens) == (len(lengths), sum(lengths))
    for limit in (0, 1, 10, 2048, 10**6):
        assert truncated_total(counts, limit).collect()[0].truncated_total == sum(min(n, limit) for n in lengths)
    for q in (0.0, 0.5, 0.9, 1.0):
        want = sorted(lengths)[max(0, int(np.ceil(q * len(lengths))) - 1)]
        assert quantile(counts, q).collect()[0].tokens == want


def test_shards_are_gapless_even_and_repeatable(spark, tmp_path):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"),
                                    F.lit(1).alias("shard"))
    placed = shard_documents(docs)
    rows = placed.toPandas()
    assert sorted(rows.doc_id) == list(range(1000)) and rows["size"].unique() == [17]
    sizes = rows.groupby("shard").slot.agg(["count", "max", "nunique"])
    assert len(sizes) == 24 and sizes["count"].max() - sizes["count"].min() <= 1
    assert (sizes["max"] + 1 == sizes["count"]).all() and (sizes["nunique"] == sizes["count"]).all()
    again = shard_documents(docs.repartition(7)).toPandas()
    key = ["doc_id", "shard", "slot"]
    assert (rows.sort_values(key)[key].to_numpy() == again.sort_values(key)[key].to_numpy()).all()
    assert not np.array_equal(rows.sort_values(["slot", "shard"]).doc_id, np.arange(1000))
    write_shards(placed, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).filter("shard = 5").count() == sizes["count"][5]


def test_buckets_keep_the_law_with_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, None, 0)] * 5 + [(n, "t" * n, n) for n in range(40)]
    records = spark.createDataFrame(rows, "doc_id long, text string, bucket int")
    placed = external_shuffle(records, F.coalesce(F.length("text"), F.lit(0)), 4, bucket_bytes=50)
    found = placed.select("record.*", "shard", "slot").toPandas()
    assert len(found) == 45 and found.doc_id.isna().sum() == 5
    assert set(found.groupby("shard").slot.count()) == {11, 12}
    assert found.drop_duplicates(["shard", "slot"]).shape[0] == 45


def test_equal_records_are_spread_over_buckets(spark):
    same = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a repeated row").alias("text"))
    nothing = spark.range(9_000).select(F.lit(None).cast("long").alias("doc_id"),
                                        F.lit(None).cast("string").alias("text"))
    rest = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    records = same.unionAll(nothing).unionAll(rest)
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(8)
    held = scatter(records, size, 50, bucket_bytes=10_000).groupBy("bucket").count().toPandas()["count"]
    assert held.sum() == 29_500 and len(held) == 50 and held.max() < 2 * held.mean()
    placed = external_shuffle(records, size, 7, bucket_bytes=10_000)
    found = placed.select("record.*", "shard", "slot").toPandas()
    assert found.doc_id.isna().sum() == 9_000 and (found.text == "a repeated row").sum() == 20_000
    assert sorted(found[found.text == "x"].doc_id) == list(range(500))
    assert found.drop_duplicates(["shard", "slot"]).shape[0] == 29_500
    assert set(found.groupby("shard").slot.max() + 1) == {4214, 4215}
    again = external_shuffle(records.repartition(5), size, 7, bucket_bytes=10_000).select("record.*", "shard", "slot")
    order = ["shard", "slot"]
    assert found.sort_values(order, ignore_index=True).equals(again.toPandas().sort_values(order, ignore_index=True))


def test_equal_pieces_are_numbered_by_their_count(spark):
    rows = (spark.range(10_000).select(F.lit(5).alias("k"), F.lit(None).cast("long").alias("id"), F.lit("a").alias("v"))
            .unionAll(spark.range(300).select((F.col("id") % 2 + 5).cast("int"), F.col("id"), F.lit("b"))))
    numbered = ordinals(rows, "k", ["id", "v"], "n", 10_300).toPandas()
    for key, count in ((5, 10_150), (6, 150)):
        assert sorted(numbered[numbered.k == key].n) == list(range(count))
    assert numbered.id.isna().sum() == 10_000


def test_ordinals_and_prefix_sums(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id"))
    numbered = ordinals(rows, "k", ["id"], "n", 500).toPandas()
    for _, own in numbered.groupby("k"):
        assert sorted(own.n) == list(range(len(own)))
    sums = prefix_sums(spark.range(300).select("id", F.col("id").alias("v")), "id", "v", "s", fan=7)
    assert all(r.s == r.id * (r.id - 1) // 2 for r in sums.collect())
