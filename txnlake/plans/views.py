"""Views over gold and stream tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions.amount import exact_mean
from txnlake.functions.components import summed
from txnlake.operators.silver import FLAGGED
from txnlake.schemas import STREAM_NESTED_SCHEMA, V_COLS


def union_all(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def stream_rates(realtime: DataFrame, *keys: Column) -> DataFrame:
    """Transactions, frauds, rate, mean amount and newest processing time of the stream per key."""
    frauds = F.count_if(F.col("fraud_class") == 1)
    return realtime.groupBy(*keys).agg(
        frauds.alias("fraud_count"),
        F.count(F.lit(1)).alias("total_transactions"),
        (frauds / F.count(F.lit(1))).alias("fraud_rate"),
        F.avg("amount").alias("avg_amount"),
        F.max("processed_at").alias("created_at"),
    )


def fraud_analytics_unified(hourly: DataFrame, realtime: DataFrame) -> DataFrame:
    """Batch hours and stream groups in one shape."""
    batch = hourly.select(
        F.lit("batch").alias("source_type"),
        "timestamp",
        F.col("Hour").alias("hour"),
        "fraud_count",
        "total_transactions",
        "fraud_rate",
        "avg_amount",
        "created_at",
    )
    stream = stream_rates(realtime, F.col("processed_at").alias("timestamp"), F.hour("time_stamp").alias("hour"))
    return batch.unionByName(stream.withColumn("source_type", F.lit("realtime")))


SETS = ["current", "train", "test"]
SUMMARY_COLS = [
    "total_transactions", "fraud_transactions", "fraud_rate", "avg_amount", "stddev_amount", "min_amount", "max_amount",
    "avg_outlier_features_per_transaction",
]


def _sample_count() -> Column:
    return F.expr(summed([f"CAST({c}_IsOutlier AS INT)" for c in FLAGGED])).alias("outlier_count_sample")


def ml_combined(sets: dict[str, DataFrame]) -> DataFrame:
    """All feature sets with their name and the number of set flags among the first five."""
    return union_all(
        *[df.select(F.lit(name).alias("dataset_type"), "Time", *V_COLS, "Amount", "Class", _sample_count()) for name, df in sets.items()]
    )


def by_set(features: DataFrame, *measures: Column) -> DataFrame:
    """Measures of the whole feature table (``current``) and of each side of its split, in one scan.

    The whole is the rollup of the sides. A set without rows has none.
    """
    rolled = features.rollup("split").agg(F.grouping("split").alias("_whole"), *measures)
    name = F.when(F.col("_whole") == 1, "current").otherwise(F.col("split"))
    return rolled.withColumn("dataset", name).where(F.col("dataset").isin(SETS)).drop("split", "_whole")


def _summary() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(F.col("Class") == 1).alias("fraud_transactions"),
        F.avg(F.col("Class").cast("double")).alias("fraud_rate"),
        exact_mean("Amount").alias("avg_amount"),
        F.stddev("Amount").alias("stddev_amount"),
        F.min("Amount").alias("min_amount"),
        F.max("Amount").alias("max_amount"),
        F.avg("outlier_count_sample").alias("avg_outlier_features_per_transaction"),
    ]


def fraud_summary(features: DataFrame) -> DataFrame:
    """Per feature set, from the feature table with its ``split``."""
    counted = features.select("split", "Class", "Amount", _sample_count())
    return by_set(counted, *_summary()).select(F.col("dataset").alias("dataset_type"), *[F.col(c) for c in SUMMARY_COLS])


STREAM_TEXT_SCHEMA = "time DOUBLE, amount DOUBLE, fraud_class LONG, risk_score DOUBLE, v1 DOUBLE, v2 DOUBLE, v3 DOUBLE"


def stream_parsed(raw: DataFrame) -> DataFrame:
    """Seven typed fields of the JSON text, parsed once per line, and the hour folder."""
    doc = F.from_json("json_data", STREAM_TEXT_SCHEMA)
    return raw.select(doc.alias("d"), "hour_bucket").select(
        "d.time", "d.amount", F.col("d.fraud_class").alias("class"), "d.risk_score", "d.v1", "d.v2", "d.v3", "hour_bucket"
    )


def stream_nested(realtime: DataFrame) -> DataFrame:
    """Stream records as one ``data`` struct."""
    renamed = {"id": "transaction_id", "rolling_amount_mean": "amount_rolling_mean", "rolling_amount_std": "amount_rolling_std"}
    fields = STREAM_NESTED_SCHEMA["data"].dataType.fields
    return realtime.select(
        F.struct(*[F.col(renamed.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in fields]).alias("data")
    )
