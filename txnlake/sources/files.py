"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.schemas import BRONZE_SCHEMA, CORRUPT, STREAM_NESTED_SCHEMA
from txnlake.sources import shared

BUCKET_PATTERN = r".*/(?:hour_bucket=)?(\d{4}-\d{2}-\d{2}--\d{2})/.*"
SNAPSHOT_PREFIX = "creditcard_sample_"
ROWS_PER_FILE = 5_000_000
# Six digits of a second; the default of the CSV writer keeps three.
CSV_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def land_raw(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy raw text lines to the bronze area with their origin; return the verification rows.

    One row per source file: its size and time, its lines, and whether as many lines were read back.
    """
    meta = F.col("_metadata")
    raw = spark.read.text(source).select(
        "value",
        meta["file_path"].alias("source_file"),
        meta["file_size"].alias("source_bytes"),
        meta["file_modification_time"].cast("timestamp_ntz").alias("source_modified"),
    )
    raw.write.mode("overwrite").parquet(target)

    def lines(df, name):
        return df.groupBy("source_file", "source_bytes", "source_modified").agg(F.count(F.lit(1)).alias(name))

    read, landed = lines(raw, "lines_read"), lines(spark.read.schema(raw.schema).parquet(target), "lines_landed")
    joined = read.join(landed, ["source_file", "source_bytes", "source_modified"], "left")
    return joined.withColumn("verified", F.coalesce(F.col("lines_read") == F.col("lines_landed"), F.lit(False)))


def read_csv(spark: SparkSession, path: str, schema: T.StructType = BRONZE_SCHEMA) -> DataFrame:
    """Typed CSV with header; a malformed line keeps its text in ``_corrupt_record``."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .options(**CSV_TIMES)
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path, time and size of the files below ``root``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "modificationTime", "length")
    )


def latest_snapshot(spark: SparkSession, root: str, prefix: str = SNAPSHOT_PREFIX, default: str = "current") -> str:
    """Folder of the newest Parquet file below ``<root>/<prefix>*``, else the default folder."""
    if not exists(spark, f"{root}/{prefix}*"):
        return f"{root}/{default}"
    files = list_files(spark, f"{root}/{prefix}*", "*.parquet")
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    newest = files.agg(F.max_by(folder, F.struct("modificationTime", "path"))).first()[0]
    return newest or f"{root}/{default}"


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches; other faults of the file system are errors."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def read_with_fallback(spark: SparkSession, parquet_path: str, csv_path: str) -> DataFrame:
    """Silver Parquet, or the bronze CSV where there is none. A faulty silver folder is an error."""
    if exists(spark, parquet_path):
        return spark.read.parquet(parquet_path)
    return read_csv(spark, csv_path).drop(CORRUPT)


def read_json_text(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as one text column, with the hour folder they came from."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(path)
        .select(F.col("value").alias("json_data"), path_bucket().alias("hour_bucket"))
    )


def path_bucket():
    """Hour folder taken from the path of the file a row was read from."""
    return F.regexp_extract(F.col("_metadata.file_path"), BUCKET_PATTERN, 1)


def read_json_nested(spark: SparkSession, path: str, schema: T.StructType = STREAM_NESTED_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)


def bind_by_position(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rename columns by position after checking that count and types agree."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns, {len(schema.fields)} declared")
    wrong = [
        f"{have.name} {have.dataType.simpleString()} is not {want.name} {want.dataType.simpleString()}"
        for have, want in zip(df.schema.fields, schema.fields)
        if have.dataType != want.dataType
    ]
    if wrong:
        raise TypeError("; ".join(wrong))
    return df.toDF(*schema.names)


def write_versioned(df: DataFrame, root: str, version: str, prefix: str = SNAPSHOT_PREFIX, current: str = "current") -> tuple[str, str]:
    """Write a stamped copy and make it the current one. Returns its folder and the manifest that names it.

    Rows are written once: ``<root>/<current>.json`` names the folder and is replaced as a whole, so a reader (see
    :func:`current_snapshot`) has the version before or the new one. A version written again gets a folder of its own, since the old
    one may be read.
    """
    spark, name, again = df.sparkSession, f"{prefix}{version}", 1
    while exists(spark, f"{root}/{name}"):
        again += 1
        name = f"{prefix}{version}.{again}"
    df.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{root}/{name}")
    manifest = f"{root}/{current}.json"
    shared.put_json(spark, manifest, {"folder": name})
    return f"{root}/{name}", manifest


def current_snapshot(spark: SparkSession, root: str, current: str = "current") -> str:
    """Folder of the current version."""
    return f"{root}/{shared.get_json(spark, f'{root}/{current}.json')['folder']}"


def write_gold(df: DataFrame, path: str, partition_by: Sequence[str] = (), whole: bool = False) -> None:
    """Overwrite a gold data set; with partitions only those present in ``df`` are replaced, unless it is ``whole``.

    Partitioned output is rebalanced first, so each partition gets few, evenly sized files.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
        mode = "static" if whole else "dynamic"
        df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).options(**CSV_TIMES).csv(path)


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Per data set (first folder below ``root``): files, size in MB, newest change."""
    base = root.rstrip("/").split("/")[-1]
    dataset = F.regexp_extract("path", rf".*/{base}/([^/]+)", 1)
    return (
        list_files(spark, root)
        .groupBy(dataset.alias("dataset"))
        .agg(
            F.count(F.lit(1)).alias("files"),
            (F.sum("length") / F.lit(1024.0 * 1024.0)).alias("size_mb"),
            F.max("modificationTime").cast("timestamp_ntz").alias("last_modified"),
        )
    )


def inventory_total(inv: DataFrame) -> DataFrame:
    return inv.agg(
        F.count(F.lit(1)).alias("datasets"),
        F.sum("size_mb").alias("total_mb"),
        F.max_by("dataset", F.struct("last_modified", "dataset")).alias("latest_dataset"),
        F.max("last_modified").alias("last_modified"),
    )
