"""Event-time windows; the same functions serve batch tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.operators import scale


def _with_watermark(df: DataFrame, ts: str, late: str | None) -> DataFrame:
    return df.withWatermark(ts, late) if df.isStreaming and late else df


def _event_time(df: DataFrame, ts: str) -> DataFrame:
    """Windows and watermarks take a plain timestamp (session time zone UTC)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def velocity(df: DataFrame, ts: str = "time_stamp", length: str = "5 minutes", late: str | None = "10 minutes") -> DataFrame:
    """Transactions per account and tumbling window."""
    timed = _with_watermark(_event_time(df, ts), ts, late)
    counts = timed.groupBy("account_id", F.window(ts, length).alias("w")).agg(F.count(F.lit(1)).alias("transactions"))
    return counts.select("account_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "transactions")


HOURLY = [
    "fraud_count",
    "total_transactions",
    "total_amount",
    "avg_amount",
    "median_amount",
    "std_amount",
    "avg_data_quality",
    "fraud_rate",
]


def hourly(df: DataFrame, ts: str = "time_stamp", late: str | None = "1 hour") -> DataFrame:
    """The hourly gold measures over event time, for records in stream columns.

    The median is exact: a batch folds counts per amount first, a stream keeps them in the state of its open hours.
    """
    timed = _with_watermark(_event_time(df, ts), ts, late)
    amount = F.col("amount")
    measures = [
        F.sum("fraud_class").cast("long").alias("fraud_count"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(amount).alias("total_amount"),
        F.avg(amount).alias("avg_amount"),
        F.stddev(amount).alias("std_amount"),
        F.avg("data_quality_score").alias("avg_data_quality"),
        (F.sum("fraud_class") / F.count(F.lit(1))).alias("fraud_rate"),
    ]
    if df.isStreaming:
        median = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY amount)").alias("median_amount")
        out = timed.groupBy(F.window(ts, "1 hour").alias("w")).agg(*measures, median)
    else:
        rows = timed.select("*", F.window(ts, "1 hour").alias("w"))
        out = scale.with_group_median(rows.groupBy("w").agg(*measures), rows, ["w"], "amount", "median_amount")
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("timestamp"), *HOURLY)
