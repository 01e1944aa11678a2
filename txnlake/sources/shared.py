"""Small files and folders of a shared store, through Hadoop's file systems (any path Spark can read)."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _at(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all below it; nothing happens where there is none."""
    where, fs = _at(spark, path)
    fs.delete(where, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of files and folders directly below, sorted."""
    where, fs = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def put_json(spark: SparkSession, path: str, value) -> None:
    """Write a small JSON file that readers see whole or not at all: written aside, then renamed."""
    where, fs = _at(spark, path)
    aside, _ = _at(spark, f"{where.getParent()}/.{where.getName()}.tmp")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        out.close()
    fs.delete(where, False)
    if not fs.rename(aside, where):
        raise OSError(f"could not rename to {path}")


def get_json(spark: SparkSession, path: str):
    where, fs = _at(spark, path)
    stream = fs.open(where)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
