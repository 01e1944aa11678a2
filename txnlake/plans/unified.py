"""Analytics over batch and stream together. ``as_of`` stands for the clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions.components import unpivoted
from txnlake.functions.scoring import ANOMALY_SHARE
from txnlake.functions.timing import micros
from txnlake.operators import scale
from txnlake.operators.gold import since
from txnlake.plans.views import stream_rates, union_all
from txnlake.schemas import V_COLS
from txnlake.streaming.features import alerts

MATCH_SECONDS = 3600


def _days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))


def _for(source: str, column: str) -> Column:
    return F.when(F.col("source") == source, F.col(column))


def batch_vs_realtime(hourly: DataFrame, realtime: DataFrame, as_of: Column) -> DataFrame:
    """Fraud rates of the last day per hour of day, batch beside stream."""
    day_ago = as_of - _days(1)
    batch = since(hourly, "created_at", day_ago).select(
        F.lit("batch").alias("source"), F.col("Hour").alias("hour"), "fraud_rate", "total_transactions"
    )
    stream = stream_rates(since(realtime, "processed_at", day_ago), F.hour("time_stamp").alias("hour")).select(
        F.lit("realtime").alias("source"), "hour", "fraud_rate", "total_transactions"
    )
    return (
        batch.unionByName(stream)
        .groupBy("hour")
        .agg(
            F.max(_for("batch", "fraud_rate")).alias("batch_fraud_rate"),
            F.max(_for("realtime", "fraud_rate")).alias("realtime_fraud_rate"),
            F.max(_for("batch", "total_transactions")).alias("batch_transactions"),
            F.max(_for("realtime", "total_transactions")).alias("realtime_transactions"),
        )
        .orderBy("hour")
    )


def high_risk(realtime: DataFrame, top: int = 100) -> DataFrame:
    """The riskiest alerts; equal scores by key."""
    return (
        alerts(realtime)
        .select(
            F.lit("realtime").alias("source"),
            "transaction_id",
            "amount",
            "risk_score",
            "is_anomaly",
            F.col("fraud_class").alias("actual_fraud"),
            "processed_at",
        )
        .orderBy(F.desc("risk_score"), "transaction_id")
        .limit(top)
    )


def feature_quality(current: DataFrame, realtime: DataFrame) -> DataFrame:
    batch = current.agg(
        F.lit("batch").alias("pipeline"),
        F.count(F.lit(1)).alias("total_records"),
        F.avg("DataQuality_Score").alias("avg_quality_score"),
        F.avg("Outlier_Ratio").alias("avg_outlier_ratio"),
        F.max("created_at").alias("latest_update"),
    )
    stream = realtime.agg(
        F.lit("stream").alias("pipeline"),
        F.count(F.lit(1)).alias("total_records"),
        F.avg(F.when(F.col("risk_score").isNotNull(), 1.0).otherwise(0.5)).alias("avg_quality_score"),
        F.avg(F.when(F.col("is_anomaly"), 1.0).otherwise(0.0)).alias("avg_outlier_ratio"),
        F.max("processed_at").alias("latest_update"),
    )
    return batch.unionByName(stream)


def hourly_unified(hourly: DataFrame, realtime: DataFrame, as_of: Column) -> DataFrame:
    """Transactions and rates per date and hour of the last seven days.

    The date filter is put on the raw timestamps and on the day folders, where it prunes the scan.
    """
    first = F.to_date(as_of) - F.expr("INTERVAL 7 DAYS")
    shape = ["source", "hour", "analysis_date", "total_transactions", "fraud_rate"]
    batch = since(hourly, "created_at", first.cast("timestamp_ntz")).select(
        F.lit("batch").alias("source"),
        F.col("Hour").alias("hour"),
        F.to_date("created_at").alias("analysis_date"),
        "total_transactions",
        "fraud_rate",
    )
    recent = since(realtime, "processed_at", first.cast("timestamp_ntz"))
    stream = (
        recent.groupBy(F.hour("time_stamp").alias("hour"), F.to_date("processed_at").alias("analysis_date"))
        .agg(F.count(F.lit(1)).alias("total_transactions"), (F.sum("fraud_class") / F.count(F.lit(1))).alias("fraud_rate"))
        .withColumn("source", F.lit("realtime"))
        .select(*shape)
    )
    return (
        batch.unionByName(stream)
        .groupBy("hour", "analysis_date")
        .agg(
            F.sum(F.coalesce(_for("batch", "total_transactions"), F.lit(0))).alias("batch_transactions"),
            F.sum(F.coalesce(_for("realtime", "total_transactions"), F.lit(0))).alias("realtime_transactions"),
            F.avg(_for("batch", "fraud_rate")).alias("batch_fraud_rate"),
            F.avg(_for("realtime", "fraud_rate")).alias("realtime_fraud_rate"),
        )
        .orderBy(F.desc("analysis_date"), "hour")
    )


def top_features(current: DataFrame) -> DataFrame:
    """Mean of every component for frauds and for the rest, by absolute difference; one scan for all."""

    def mean_of(label: int) -> Column:
        return F.avg(F.when(F.col("Class") == label, F.col("value")))

    means = (
        unpivoted(current, V_COLS, "Class")
        .groupBy(F.col("column").alias("feature_name"))
        .agg(mean_of(1).alias("avg_fraud_value"), mean_of(0).alias("avg_normal_value"))
    )
    return means.withColumn("fraud_difference", F.col("avg_fraud_value") - F.col("avg_normal_value")).orderBy(
        F.desc(F.abs("fraud_difference")), "feature_name"
    )


def freshness(tables: dict[str, tuple[DataFrame, str]], as_of: Column) -> DataFrame:
    """Per table: rows, oldest and newest entry, age of the newest."""
    return union_all(
        *[
            df.agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("record_count"),
                F.min(ts).alias("oldest_record"),
                F.max(ts).alias("newest_record"),
                (as_of - F.max(ts)).alias("data_age"),
            )
            for name, (df, ts) in tables.items()
        ]
    )


def prediction_accuracy(current: DataFrame, realtime: DataFrame, within_seconds: int = MATCH_SECONDS) -> DataFrame:
    """Accuracy of both predictions over all batch/stream pairs closer than an hour.

    A pair needs both labels. The pairs are only counted, see :func:`scale.pairs_within`.
    """

    def flag(condition: Column) -> Column:
        return F.when(condition, F.lit(1)).otherwise(F.lit(0))

    batch = current.where("Class IS NOT NULL").select(
        micros(F.col("created_at")).alias("us"),
        flag(F.col("Outlier_Ratio") > ANOMALY_SHARE).alias("predicted"),
        F.col("Class").alias("actual"),
    )
    stream = realtime.where("fraud_class IS NOT NULL").select(
        micros(F.col("processed_at")).alias("us"), flag(F.col("is_anomaly")).alias("predicted"), F.col("fraud_class").alias("actual")
    )
    weights = {
        "all": F.lit(1),
        "right": flag(F.col("predicted") == F.col("actual")),
        "yes": F.col("predicted"),
        "no": 1 - F.col("predicted"),
    }
    sums = scale.pairs_within(
        batch,
        stream,
        "us",
        within_seconds * 1_000_000,
        weights,
        weights,
        {
            "total_comparisons": [("all", "all")],
            "batch_right": [("right", "all")],
            "stream_right": [("all", "right")],
            "agreeing": [("yes", "yes"), ("no", "no")],
        },
    )

    def share(c: str) -> Column:
        total = F.col("total_comparisons")
        return F.when(total > 0, F.col(c).cast("double") / total.cast("double"))

    return sums.select(
        "total_comparisons",
        share("batch_right").alias("batch_accuracy"),
        share("stream_right").alias("stream_accuracy"),
        share("agreeing").alias("prediction_agreement"),
    )
