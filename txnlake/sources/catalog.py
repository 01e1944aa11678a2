"""Schemas, external tables and views in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMAS = ("gold_batch", "gold_stream", "gold_ml", "gold_analytics", "gold_streaming")


def create_schemas(spark: SparkSession, root: str, names: tuple[str, ...] = SCHEMAS) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root}/{name}'")


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str, fmt: str = "PARQUET", replace: bool = False
) -> None:
    """External table over a folder; ``replace`` drops an older definition (never its files)."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt} LOCATION '{location}'")


def create_folder_table(spark: SparkSession, name: str, location: str) -> None:
    """External table over a written data set, with its columns and partitions."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING PARQUET LOCATION '{location}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name}")


def create_like(spark: SparkSession, name: str, like: str, location: str) -> None:
    """External table with the columns of another one, at its own location."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} LIKE {like} USING PARQUET LOCATION '{location}'")


def create_text_table(spark: SparkSession, name: str, location: str) -> None:
    """Raw JSON lines as one text column; hour folders are read recursively."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (json_data STRING) USING TEXT "
        f"OPTIONS (recursiveFileLookup 'true') LOCATION '{location}'"
    )


def register_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def list_schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS")
