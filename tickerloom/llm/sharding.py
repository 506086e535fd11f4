"""Two-pass external shuffle of records into numbered shards.

Pass one scatters records over memory-sized buckets by a seeded hash of the whole record.
Pass two shuffles every bucket in memory (Fisher-Yates, seeded per bucket) and writes it.
The buckets one after another are the shuffled order of the table, which is dealt to the
shards in turn: row counts differ by one at most, and slots have no gaps. Both passes
depend on contents and seed only, so a repeated task gives the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import documents, each_copy, prefix_sums, stored

#: Text bytes a bucket holds on average; one bucket at a time is in a Python task's memory.
BUCKET_BYTES = 8 << 20
SHARDS = 24
SEED = 20_240_601


def scatter(records: DataFrame, record_bytes, buckets: int, seed: int = SEED,
            bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Pass one: (record, bucket, order), uniform over the buckets.

    Records that share a key, a source or a text still differ somewhere and are spread by
    their hash. Records equal in all columns are spread by the number of the copy where
    together they would fill an eighth of a bucket; there are at most eight such records a bucket.
    """
    record = F.struct(*[records[c] for c in records.columns])
    named = records.select(record.alias("record"), F.xxhash64(record).alias("name"),
                           record_bytes.cast("long").alias("bytes"))
    # Records that only share the hash of a large group are counted one by one below.
    large = stored(named.groupBy("name").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
                   .filter((F.col("n") > 1) & (F.col("bytes") * 8 > bucket_bytes)).select("name"),
                   "repeated-records")

    def placed(rows: DataFrame, *copy: str) -> DataFrame:
        return rows.select(
            "record", F.pmod(F.xxhash64(F.lit(seed), "record", *copy), F.lit(buckets)).alias("bucket"),
            F.xxhash64("record", *copy, F.lit(seed)).alias("order"))

    if large.isEmpty():
        return placed(named)
    repeated = (named.join(large, "name", "left_semi").groupBy("record")
                .agg(F.count(F.lit(1)).alias("copies")))
    return (placed(named.join(large, "name", "left_anti"))
            .unionAll(placed(each_copy(repeated, "copies", "copy"), "copy")))


def external_shuffle(records: DataFrame, record_bytes, shards: int = SHARDS, seed: int = SEED,
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(record, shard, slot): a uniform shuffle of all rows, dealt to ``shards`` in turn.

    ``record_bytes`` is a column with a record's size. Columns of ``records`` stay inside the
    struct, so no name can clash. NULLs hash like any value; an empty table gives no rows.
    """
    total = records.agg(F.coalesce(F.sum(record_bytes), F.lit(0))).first()[0]
    buckets = max(1, -(-int(total) // bucket_bytes))
    scattered = scatter(records, record_bytes, buckets, seed, bucket_bytes)
    counts = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = prefix_sums(counts, "bucket", "n", "start").select(F.col("bucket").alias("of"), "start")
    schema = scattered.select("record").schema
    schema = schema.add("shard", "integer").add("slot", "long")

    def shuffle(bucket: pa.Table, start: pa.Table) -> pa.Table:
        ordered = bucket.take(pc.sort_indices(bucket["order"]))
        number = bucket["bucket"][0].as_py()
        at = np.arange(ordered.num_rows, dtype=np.int64)
        draws = np.random.default_rng([seed, number])
        draws.shuffle(at)           # Fisher-Yates
        position = np.arange(ordered.num_rows, dtype=np.int64) + start["start"][0].as_py()
        return pa.table({"record": ordered["record"].take(pa.array(at)),
                         "shard": pa.array((position % shards).astype(np.int32)),
                         "slot": pa.array(position // shards)})

    return (scattered.groupBy("bucket").cogroup(starts.groupBy("of"))
            .applyInArrow(shuffle, schema))


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id`` and ``text`` of every row with its shard and slot, law ``rows``.

    Size is the UTF-8 bytes of the text plus 8; a NULL text has none. Repeated rows are
    placed one by one; other columns are not carried.
    """
    records = documents(docs)
    placed = external_shuffle(records, F.octet_length("text") + F.lit(8), shards, seed)
    return placed.select("record.doc_id", "record.text",
                         (F.octet_length("record.text") + F.lit(8)).cast("long").alias("size"),
                         "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write straight from the bucket tasks: one folder per shard, ``slot`` gives the order."""
    sharded.write.partitionBy("shard").mode("overwrite").parquet(path)
