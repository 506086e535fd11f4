"""Queries on periods that are delivered in turn, against their SQL on a table made for it."""

from datetime import datetime, timedelta

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tickerloom.catalog import feeds
from tickerloom.catalog import queries as catalog


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Events every half hour of a month; among those held back is one of the hour that is still
    open when the first period ends."""
    start = datetime(2024, 1, 1)
    rows = [(n, start + timedelta(minutes=30 * n), n, "click", 1.0 + n % 7, f'{{"k": {n % 60}}}')
            for n in range(1450)]
    last_hour = datetime(2024, 1, 10, 23)
    rows += [(5000 + 50 * n + late, last_hour + timedelta(minutes=10 + n), n, "click", 2.0, '{"k": 3}')
             for n in range(6) for late in (3, 7)]
    folder = str(tmp_path_factory.mktemp("month"))
    spark.createDataFrame(rows, feeds.EVENTS).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


def equals_sql(spark, folder, name):
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
        found = duck.execute(oracle_sql()[name])
        columns = [column[0] for column in found.description]
        want = found.fetchall()
    got = [tuple(row) for row in queries()[name](spark, folder).select(*columns).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert got


def test_rows_held_back_from_an_hour_open_at_the_end_of_its_period_are_dropped(spark, table):
    equals_sql(spark, table, "stream_late_windows")


def test_a_period_of_a_table_in_one_file_is_written_by_several_tasks(spark, table, tmp_path):
    folder, key = str(tmp_path / "messages"), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        catalog._delivered_files(spark, table, folder, [1])
    finally:
        spark.conf.unset(key)
    by_file = spark.read.parquet(folder).groupBy("_metadata.file_path").count().collect()
    assert len(by_file) > 1
    assert sum(row["count"] for row in by_file) == 480


def test_late_rows_are_those_of_the_periods_before(spark, table):
    equals_sql(spark, table, "late_rows_side_table")


def test_restart_audit_reads_every_period_in_one_micro_batch(spark, table, monkeypatch):
    """However many files the period has."""
    batches, finish = [], catalog.streams.finish

    def counted(started):
        finish(started)
        batches.extend(p["batchId"] for p in started["log"].recentProgress if p["numInputRows"])

    monkeypatch.setattr(catalog.streams, "finish", counted)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        equals_sql(spark, table, "stream_restart_audit")
    finally:
        spark.conf.unset(key)
    assert batches == [0, 1, 2]
