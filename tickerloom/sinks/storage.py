"""Small files beside tables: written whole, put in place by one rename, listed by name.

All calls go through the file system that Spark itself uses for a path, on the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _listed(spark: SparkSession, folder: str):
    files, place = _located(spark, folder)
    return files.listStatus(place) if files.exists(place) else None


def count(spark: SparkSession, folder: str) -> int:
    """Files and folders directly below a folder."""
    found = _listed(spark, folder)
    return 0 if found is None else len(found)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder without hidden ones, sorted; none if there is no such folder."""
    found = (status.getPath().getName() for status in _listed(spark, folder) or ())
    return sorted(name for name in found if name[0] not in "._")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a whole folder; nothing happens if there is none."""
    files, place = _located(spark, path)
    files.delete(place, True)


def move(spark: SparkSession, source: str, target: str, replace: bool = False) -> None:
    """One rename. With ``replace`` a file at ``target`` is replaced in the same step; without,
    anything there is an error."""
    files, place = _located(spark, source)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.makeQualified(place).toUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    modes = spark.sparkContext._gateway.new_array(kind, 1)
    modes[0] = kind.valueOf("OVERWRITE" if replace else "NONE")
    into, target_place = _located(spark, target)
    into.mkdirs(target_place.getParent())
    context.rename(files.makeQualified(place), into.makeQualified(target_place), modes)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; readers see the old one or the whole new one."""
    folder, _, name = path.rpartition("/")
    unfinished = f"{folder}/.{name}.{uuid.uuid4().hex}"
    files, place = _located(spark, unfinished)
    out = files.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    move(spark, unfinished, path, replace=True)


def get_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; ``None`` if there is none."""
    files, place = _located(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
