"""Merging a group with a batch that is larger than a file."""

from pyspark.sql import functions as F

from tickerloom.sinks.versioned import GROUP_SIZE, as_of, merge_groups, write_batch


def test_a_large_batch_is_dealt_over_several_files(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(2000).withColumn("same", F.lit("x"))
    write_batch(rows, 0, path)
    write_batch(rows.limit(10), 3, path)
    write_batch(rows.limit(5), GROUP_SIZE, path)
    assert merge_groups(spark, path, rows_per_file=200) == [0]
    merged = spark.read.parquet(f"{path}_merged/batch_group=0-*")
    by_file = [r["count"] for r in merged.groupBy("_metadata.file_path").count().collect()]
    assert len(by_file) >= 8 and max(by_file) <= 600
    assert as_of(spark, path, 3).count() == 2010
    assert as_of(spark, path, 0).select("id").distinct().count() == 2000
