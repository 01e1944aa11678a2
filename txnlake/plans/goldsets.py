"""Analytics over the ML feature sets, and the documented ad-hoc queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions.amount import amount_band, rounded_mean
from txnlake.functions.components import unpivoted
from txnlake.functions.timing import HOUR
from txnlake.operators import scale
from txnlake.operators.silver import FLAGGED
from txnlake.plans.views import SETS, by_set
from txnlake.schemas import V_COLS

FLAGS = [*FLAGGED, "Amount"]


def _frauds() -> Column:
    return F.count_if(F.col("Class") == 1)


def _rate_percent() -> Column:
    return F.round(F.avg(F.col("Class").cast("double")) * 100, 4)


def _of_all_sets(measured: DataFrame, *counts: str) -> DataFrame:
    """Sets without rows too, with counts of 0."""
    names = measured.sparkSession.createDataFrame([(n,) for n in SETS], "dataset string")
    return names.join(measured, "dataset", "left").na.fill(0, list(counts))


def dataset_counts(features: DataFrame) -> DataFrame:
    """Rows of the feature table and of its two sides, in one scan of the column ``split``."""
    counted = _of_all_sets(by_set(features, F.count(F.lit(1)).alias("record_count")), "record_count")
    return counted.select(F.concat(F.lit("ml_features_"), "dataset").alias("table_name"), "record_count")


def fraud_summary(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.desc("fraud_rate"), "dataset_type").select(
        "dataset_type",
        "total_transactions",
        "fraud_transactions",
        F.round(F.col("fraud_rate") * 100, 4).alias("fraud_rate_percent"),
        F.round("avg_amount", 2).alias("avg_amount"),
        F.round("stddev_amount", 2).alias("stddev_amount"),
        F.round("avg_outlier_features_per_transaction", 2).alias("avg_outlier_features"),
    )


def amount_by_class(current: DataFrame, **limits) -> DataFrame:
    """Amount statistics per label, with exact interpolated percentiles."""
    stats = current.groupBy("Class").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        rounded_mean("Amount").alias("avg_amount"),
        F.stddev("Amount").alias("stddev_amount"),
        F.min("Amount").alias("min_amount"),
        F.max("Amount").alias("max_amount"),
    )
    # One series per label that occurs: few by nature.
    labels = [r["Class"] for r in current.where("Class IS NOT NULL").select("Class").distinct().collect()]
    series = {str(k): F.when(F.col("Class") == k, F.col("Amount")) for k in sorted(labels)}
    quantiles = scale.exact_quantiles(current, series, [0.5, 0.95], **limits)
    wide = quantiles.groupBy(F.col("series").cast("int").alias("Class")).agg(
        F.max(F.when(F.col("prob") == 0.5, F.col("value"))).alias("median_amount"),
        F.max(F.when(F.col("prob") == 0.95, F.col("value"))).alias("p95_amount"),
    )
    numbers = ["avg_amount", "stddev_amount", "min_amount", "max_amount", "median_amount", "p95_amount"]
    return (
        stats.join(wide, "Class", "left")
        .select(F.col("Class").alias("fraud_class"), "transaction_count", *[F.round(c, 2).alias(c) for c in numbers])
        .orderBy("fraud_class")
    )


def hour_buckets(current: DataFrame, first: int = 24) -> DataFrame:
    """The first hours of the table: transactions, frauds, rate and mean amount."""
    return (
        current.groupBy(F.floor(F.col("Time") / F.lit(HOUR)).alias("hour_bucket"))
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            _frauds().alias("fraud_count"),
            _rate_percent().alias("fraud_rate_percent"),
            rounded_mean("Amount").alias("avg_amount"),
        )
        .orderBy("hour_bucket")
        .limit(first)
    )


def outlier_by_class(current: DataFrame) -> DataFrame:
    """Share in % of each outlier flag among frauds and among the rest, from one pass."""
    rates = [
        F.expr(f"round(avg(IF(Class = {k}, CAST({c}_IsOutlier AS INT), NULL)) * 100, 2) AS {n}_{c}")
        for c in FLAGS
        for n, k in (("f", 1), ("n", 0))
    ]
    rows = [
        F.struct(
            F.lit(f"{c}_IsOutlier").alias("feature_name"),
            F.col(f"f_{c}").alias("fraud_outlier_rate"),
            F.col(f"n_{c}").alias("normal_outlier_rate"),
        )
        for c in FLAGS
    ]
    return current.agg(*rates).select(F.inline(F.array(*rows)))


def feature_distribution(current: DataFrame) -> DataFrame:
    """Mean, deviation and range of every component and of the amount, from one pass."""
    is_amount = F.col("column") == "Amount"
    stats = {"avg_value": F.avg, "stddev_value": F.stddev, "min_value": F.min, "max_value": F.max}
    measured = unpivoted(current, [*V_COLS, "Amount"]).groupBy("column").agg(*[f("value").alias(n) for n, f in stats.items()])
    # Rounding takes a fixed number of digits, so both roundings are made and one is kept.
    return measured.select(
        F.col("column").alias("feature_name"),
        *[F.when(is_amount, F.round(n, 2)).otherwise(F.round(n, 6)).alias(n) for n in stats],
    )


def dataset_compare(features: DataFrame) -> DataFrame:
    stats = by_set(
        features,
        F.count(F.lit(1)).alias("record_count"),
        _rate_percent().alias("fraud_rate_percent"),
        rounded_mean("Amount").alias("avg_amount"),
        F.count_if(F.col("V1_IsOutlier") == 1).alias("V1_outliers"),
    )
    stats = _of_all_sets(stats, "record_count", "V1_outliers")
    share = F.round(F.try_divide("V1_outliers", "record_count") * 100, 2)
    return stats.withColumn("outlier_percentage", share).orderBy(F.desc("record_count"), "dataset")


def amount_ranges(current: DataFrame) -> DataFrame:
    return (
        current.groupBy(amount_band(F.col("Amount")).alias("amount_range"))
        .agg(F.count(F.lit(1)).alias("transaction_count"), _frauds().alias("fraud_count"), _rate_percent().alias("fraud_rate_percent"))
        .orderBy(F.desc("fraud_rate_percent"), "amount_range")
    )


def fraud_samples(current: DataFrame, top: int = 20) -> DataFrame:
    """The largest frauds; equal amounts by key."""
    return (
        current.where(F.col("Class") == 1)
        .orderBy(F.desc("Amount"), "id")
        .limit(top)
        .select(
            "id",
            "Time",
            *[F.round(c, 4).alias(c) for c in ("V1", "V2", "V3")],
            F.round("Amount", 2).alias("Amount"),
            F.col("Class").alias("fraud_class"),
            "V1_IsOutlier",
            "V2_IsOutlier",
            "Amount_IsOutlier",
            F.when(F.col("Class") == 1, "FRAUD").otherwise("NORMAL").alias("transaction_type"),
        )
    )


def stream_sample(raw: DataFrame, rows: int = 5) -> DataFrame:
    return raw.select("json_data").orderBy("json_data").limit(rows)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("record_count"))


def class_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("Class").agg(F.count(F.lit(1)).alias("record_count")).orderBy("Class")


def training_rows(train: DataFrame, rows: int = 1000) -> DataFrame:
    return train.where("Amount IS NOT NULL").orderBy("id").limit(rows).select(*V_COLS, "Amount", "Class")


def outlier_flags_as_boolean(current: DataFrame, rows: int = 10) -> DataFrame:
    return (
        current.orderBy("id")
        .limit(rows)
        .select((F.col("V1_IsOutlier") == 1).alias("v1_isoutlier_bool"), F.col("Amount").alias("amount"), F.col("Class").alias("class"))
    )


def stream_latest(parsed: DataFrame, rows: int = 10) -> DataFrame:
    """Rows of the newest hour folders; within a folder by amount and components."""
    return parsed.orderBy(F.desc("hour_bucket"), F.desc("amount"), "v1", "v2", "v3").limit(rows)


def overall_fraud_rate(current: DataFrame) -> DataFrame:
    return current.agg(
        F.count(F.lit(1)).alias("records"), (F.avg(F.col("Class").cast("double")) * 100).alias("fraud_rate_percent")
    )


def correlation(current: DataFrame) -> DataFrame:
    """Correlation of every component and the amount with the label, from one pass."""
    label = F.col("Class").cast("double")
    return (
        unpivoted(current, [*V_COLS, "Amount"], "Class")
        .groupBy(F.col("column").alias("feature_name"))
        .agg(F.corr(F.col("value"), label).alias("correlation"))
    )
