"""Transaction table over JDBC, Kafka topics, and statistics of the source table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.operators.scale import with_scalar
from txnlake.schemas import OLTP_SCHEMA, V_COLS


def read_jdbc(spark: SparkSession, url: str, table: str, low: int, high: int, partitions: int, **options: str) -> DataFrame:
    """The source table, read in parallel by ranges of ``id``."""
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", "id")
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", partitions)
        .options(**options)
    )
    return from_oltp(reader.load())


def to_oltp(df: DataFrame) -> DataFrame:
    """Cast to the declared types of the source table."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in OLTP_SCHEMA.fields])


def from_oltp(df: DataFrame) -> DataFrame:
    """Bronze columns of the source table: decimals become doubles, names take their bronze form."""
    return df.select(
        "id",
        F.col("created_at").alias("ts"),
        F.col("time_stamp").cast("double").alias("Time"),
        *[F.col(c.lower()).cast("double").alias(c) for c in V_COLS],
        F.col("amount").cast("double").alias("Amount"),
        F.col("class").cast("int").alias("Class"),
    )


def constraint_checks(df: DataFrame) -> DataFrame:
    """The declared constraints as rules: rows breaking each of them."""
    rules = {
        "time_stamp_not_null": F.col("time_stamp").isNull(),
        "amount_not_null": F.col("amount").isNull(),
        "class_not_null": F.col("class").isNull(),
        "class_in_0_1": ~F.col("class").isin(0, 1),
    }
    wide = df.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    return wide.unpivot([], list(rules), "rule", "violations")


def table_stats(df: DataFrame, as_of: Column, label: str = "class", created: str = "created_at") -> DataFrame:
    """Rows per class with their share in %, the total, and the rows of the last hour."""
    recent = F.count_if(F.col(created) >= as_of - F.make_dt_interval(F.lit(0), F.lit(1)))
    per_class = df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("records"), recent.alias("recent"))
    # The grouped table has one row per class, so its total is read as a scalar.
    totals = per_class.agg(F.struct(F.sum("records").alias("n"), F.sum("recent").alias("r")))
    return with_scalar(per_class, totals, "t").select(
        "class",
        "records",
        (F.col("records") / F.col("t.n") * 100).alias("percentage"),
        F.col("t.n").alias("total_records"),
        F.col("t.r").alias("recent_records"),
    )


def read_kafka(spark: SparkSession, servers: str, topic: str, start: str = "earliest", **options: str) -> DataFrame:
    """Stream of messages as text (needs the Kafka connector on the class path).

    Progress lives in the query's checkpoint; ``kafka.group.id`` may be passed as an option.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .options(**options)
        .load()
        .selectExpr("CAST(value AS STRING) AS value")
    )


def read_text_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same ``value`` column from a folder of text files."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)
