import pytest
from pyspark.sql import functions as F

from tickerloom.fixed_values import UNIVERSE, WAREHOUSE_COLUMNS
from tickerloom.plans.publish import GateClosed, LoadIncomplete, publish
from tickerloom.plans.reports import health_report
from tickerloom.sinks.files import export_tables
from tickerloom.sinks.versioned import (
    SchemaMismatch,
    as_of,
    history,
    stream_batches,
    version_growth,
    write_batch,
)
from tickerloom.sinks.warehouse import JdbcSink, StagedFilesSink, warehouse_rows
from tickerloom.sources.tables import TableMissing, read_table, read_tables, require_tables

ALL = [{"ticker": t} for t in UNIVERSE]


class Recorder:
    """A sink that remembers what was loaded."""

    def __init__(self, found=25):
        self.loaded, self.found = [], found

    def load(self, df, table):
        self.loaded.append(table)

    def count(self, spark, table):
        return self.found


def numbers(spark, start, end):
    return spark.range(start, end).select("id", (F.col("id") * 1.5).alias("price"))


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_batch(numbers(spark, 0, 10), 0, path)
    write_batch(numbers(spark, 10, 30), 1, path)
    write_batch(numbers(spark, 30, 35), 2, path)
    write_batch(numbers(spark, 10, 30), 1, path)  # replay
    log = {r.version: (r.rows_written, r.operation) for r in history(spark, path).collect()}
    assert log == {0: (10, "append"), 1: (20, "append"), 2: (5, "append")}
    assert as_of(spark, path, 1).count() == 30
    assert as_of(spark, path, 1).columns == ["id", "price"]
    assert as_of(spark, path, 2).distinct().count() == 35
    assert tuple(version_growth(spark, path).collect()[0]) == (10, 35, 25)


def test_an_empty_batch_empties_its_partition_and_is_in_the_history(spark, tmp_path):
    path = str(tmp_path / "t")
    write_batch(numbers(spark, 0, 10), 0, path)
    write_batch(numbers(spark, 10, 20), 1, path)
    write_batch(numbers(spark, 0, 0), 1, path)      # replayed without rows
    write_batch(numbers(spark, 0, 0), 2, path)
    write_batch(numbers(spark, 50, 53), 2007, path)
    log = {r.version: r.rows_written for r in history(spark, path).collect()}
    assert log == {0: 10, 1: 0, 2: 0, 2007: 3}
    assert as_of(spark, path, 2).count() == 10
    assert as_of(spark, path).count() == 13
    assert as_of(spark, path, -1).count() == 0
    assert len(as_of(spark, path, 2).inputFiles()) == len(as_of(spark, path, 0).inputFiles())


def test_a_table_of_empty_batches_only(spark, tmp_path):
    path = str(tmp_path / "t")
    write_batch(numbers(spark, 0, 0), 0, path)
    assert [r.rows_written for r in history(spark, path).collect()] == [0]


def test_history_reads_no_data(spark, tmp_path):
    path = str(tmp_path / "t")
    write_batch(numbers(spark, 0, 10), 0, path)
    plan = history(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "price" not in plan
    pruned = as_of(spark, path, 0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in pruned


def test_schema_is_enforced(spark, tmp_path):
    path = str(tmp_path / "t")
    write_batch(numbers(spark, 0, 10), 0, path)
    bad = spark.createDataFrame([(1, "text", "x")], "id bigint, price string, extra string")
    with pytest.raises(SchemaMismatch, match="price is string, stored as double.*extra"):
        write_batch(bad, 1, path)
    assert read_table(spark, path).count() == 10
    # An absent column is written as NULL, and column order does not matter.
    write_batch(spark.createDataFrame([(2.5, 7)], "price double, id bigint"), 1, path)
    write_batch(spark.createDataFrame([(8,)], "id bigint"), 2, path)
    later = read_table(spark, path).filter("batch_id > 0")
    rows = {r.id: r.price for r in later.collect()}
    assert rows == {7: 2.5, 8: None}


def test_a_stream_of_other_columns_is_refused_at_the_start(spark, tmp_path):
    path = str(tmp_path / "t")
    write_batch(numbers(spark, 0, 3), 0, path)
    source = str(tmp_path / "in")
    spark.range(3).select("id", F.lit("x").alias("price")).write.parquet(source)
    stream = spark.readStream.schema("id bigint, price string").parquet(source)
    with pytest.raises(SchemaMismatch):
        stream_batches(stream, path, str(tmp_path / "state"))


def test_missing_tables(spark, tmp_path):
    numbers(spark, 0, 3).write.parquet(str(tmp_path / "here"))
    paths = {"here": str(tmp_path / "here"), "gone": str(tmp_path / "gone")}
    for schema in (None, "id bigint"):
        with pytest.raises(TableMissing):
            read_table(spark, paths["gone"], schema=schema)
    (tmp_path / "empty").mkdir()
    with pytest.raises(TableMissing):
        read_table(spark, str(tmp_path / "empty"))
    assert read_tables(spark, paths)["gone"] is None
    with pytest.raises(TableMissing, match="gone"):
        require_tables(spark, paths)


def test_health_report_names_missing_tables(spark, tmp_path, make_bars):
    make_bars({}).write.parquet(str(tmp_path / "vwap_1min"))
    report = health_report(spark, str(tmp_path))
    status = {r.table_name: r.status for r in report["tables"].collect()}
    assert status["vwap_1min"] == "OK" and status["raw_trades"] == "Missing"
    assert report["verdict"].collect()[0].healthy is False


def test_csv_export(spark, tmp_path, make_bars):
    outcome = export_tables(
        {"vwap_1min": make_bars(*ALL).repartition(3), "raw_trades": None}, str(tmp_path), True
    )
    assert outcome["raw_trades"] == "missing"
    files = list((tmp_path / "vwap_1min").glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text().startswith("ticker,vwap,low_price")
    assert spark.read.option("header", True).csv(outcome["vwap_1min"]).count() == 25


def test_warehouse_rows(make_bars):
    rows = warehouse_rows(make_bars({"window_start": "2024-01-01 10:00:00.987654"}))
    assert rows.columns == [*WAREHOUSE_COLUMNS, "_LOADED_AT"]
    row = rows.collect()[0]
    assert row.WINDOW_START == "2024-01-01 10:00:00"  # fraction cut, not rounded
    assert dict(rows.dtypes)["BUY_PRESSURE"] == "double" and row.AVG_SPREAD == 0.2


def test_warehouse_rows_need_utc(make_bars, spark):
    bars = make_bars({})
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            warehouse_rows(bars)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_publish(spark, tmp_path, make_bars):
    sink = StagedFilesSink(str(tmp_path))
    bars = make_bars(*ALL)
    assert publish(bars, bars, sink) == {"VWAP_1MIN": "loaded", "VWAP_5MIN": "loaded"}
    assert publish(bars, bars, sink)["VWAP_1MIN"] == "loaded"
    assert spark.read.parquet(str(tmp_path / "VWAP_1MIN")).count() == 25  # replaced, not doubled
    # An empty source leaves the target as it is.
    assert publish(make_bars(), bars, sink)["VWAP_1MIN"] == "skipped"
    assert spark.read.parquet(str(tmp_path / "VWAP_1MIN")).count() == 25


def test_nothing_is_published_when_a_check_fails(make_bars):
    sink = Recorder()
    with pytest.raises(GateClosed):
        publish(make_bars(*ALL, {"vwap": None}), make_bars(*ALL), sink)
    assert sink.loaded == []


def test_a_load_that_doubles_rows_is_noticed(make_bars):
    with pytest.raises(LoadIncomplete, match="VWAP_1MIN: sent 25 rows, found 26"):
        publish(make_bars(*ALL), make_bars(*ALL), Recorder(found=26))


def test_jdbc_sink_needs_a_driver(spark, make_bars):
    """No database is started here: the options are checked up to the driver lookup."""
    sink = JdbcSink("jdbc:nosuch:db", {"user": "u"})
    with pytest.raises(Exception, match="No suitable driver"):
        sink.load(warehouse_rows(make_bars({})), "VWAP_1MIN")
    with pytest.raises(Exception, match="No suitable driver"):
        sink.count(spark, "VWAP_1MIN")
