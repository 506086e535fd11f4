"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Settings that may change while a session runs.
RUNTIME_CONF = {
    # Windows, session hours and warehouse text are all defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Joins of trades with bars: when every partition of the bars turns out smaller
    # than this at run time, it is hashed and the trades are not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def recommended_conf(shuffle_partitions: int | None = None) -> dict[str, str]:
    """Settings for a long-running cluster session.

    AQE picks batch shuffle sizes at run time. A streaming query freezes its
    shuffle partition count in its checkpoint at first start, so pass
    ``shuffle_partitions`` sized for the state, not for one micro-batch.
    """
    conf = {
        **RUNTIME_CONF,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Recording the call site of every expression doubles the time to build a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # Window state outgrows the executor heap with many symbols.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return conf


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset a local temporary folder is used, which only a
    single-machine session can share between its tasks.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tickerloom-")
        spark.conf.set("spark.checkpoint.dir", shared)
    path = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


# What this process put into the shared folder.
_made: list[str] = []


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this process made; returns how many.

    Call it when no frame that reads them is needed any more.
    """
    done = 0
    while _made:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        done += bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True))
    return done


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: short lineage, real file statistics."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
