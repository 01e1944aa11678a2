"""The lake's tables and views for SQL users, and its analytic queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.plans import goldsets, pipeline, unified, views
from txnlake.sources import catalog, files

TABLES = {
    pipeline.HOURLY: "gold_batch",
    pipeline.FEATURES: "gold_ml",
    pipeline.RISK: "gold_analytics",
    pipeline.SUMMARY: "gold_analytics",
}


def feature_sets(spark: SparkSession) -> dict[str, DataFrame]:
    rows = spark.table(f"gold_ml.{pipeline.FEATURES}")
    return {"current": rows, "train": rows.where("split = 'train'"), "test": rows.where("split = 'test'")}


def register(spark: SparkSession, lake: str) -> list[str]:
    """Register the gold tables, and the views over them and over the stream's output where there is one.

    Tables are external ones of the catalog; views are the session's. Returns their names.
    """
    catalog.create_schemas(spark, f"{lake}/schemas")
    names = []
    for name, schema in TABLES.items():
        catalog.create_folder_table(spark, f"{schema}.{name}", f"{lake}/gold/{name}")
        names.append(f"{schema}.{name}")
    combined = views.ml_combined(feature_sets(spark))
    made = {"ml_features_combined": combined, "fraud_detection_summary": views.fraud_summary(spark.table(f"gold_ml.{pipeline.FEATURES}"))}
    if files.exists(spark, f"{lake}/stream/records/*"):
        records = spark.read.option("basePath", f"{lake}/stream/records").json(f"{lake}/stream/records")
        hours = spark.table(f"gold_batch.{pipeline.HOURLY}")
        stamps = {c: F.col(c).cast("timestamp_ntz") for c in ("time_stamp", "processed_at", "created_at")}
        realtime = records.withColumns(stamps)
        made |= {
            "stream_records": realtime,
            "fraud_analytics_unified": views.fraud_analytics_unified(hours, realtime),
            "stream_parsed": views.stream_parsed(files.read_json_text(spark, f"{lake}/stream/records")),
            "stream_nested": views.stream_nested(realtime),
        }
    catalog.register_views(made)
    return [*names, *made]


def _both(f: Callable[..., DataFrame]) -> Callable[[SparkSession, Column], DataFrame]:
    def run(spark: SparkSession, as_of: Column) -> DataFrame:
        return f(spark.table(f"gold_batch.{pipeline.HOURLY}"), spark.table("stream_records"), as_of)

    return run


def _features(f: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, Column], DataFrame]:
    return lambda spark, as_of: f(spark.table(f"gold_ml.{pipeline.FEATURES}"))


def _pair(f: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, Column], DataFrame]:
    return lambda spark, as_of: f(spark.table(f"gold_ml.{pipeline.FEATURES}"), spark.table("stream_records"))


def _dated(spark: SparkSession) -> dict[str, tuple[DataFrame, str]]:
    """Data sets with the column that says how new they are."""
    return {
        "fraud_analytics_batch": (spark.table(f"gold_batch.{pipeline.HOURLY}"), "created_at"),
        "ml_features_batch": (spark.table(f"gold_ml.{pipeline.FEATURES}"), "created_at"),
        "ml_features_stream": (spark.table("stream_records"), "processed_at"),
    }


# Queries of a registered lake: session and clock to a table.
QUERIES: dict[str, Callable[[SparkSession, Column], DataFrame]] = {
    "batch_vs_realtime": _both(unified.batch_vs_realtime),
    "hourly_unified": _both(unified.hourly_unified),
    "high_risk": lambda spark, as_of: unified.high_risk(spark.table("stream_records")),
    "top_features": _features(unified.top_features),
    "amount_by_class": _features(goldsets.amount_by_class),
    "hour_buckets": _features(goldsets.hour_buckets),
    "outlier_by_class": _features(goldsets.outlier_by_class),
    "feature_distribution": _features(goldsets.feature_distribution),
    "amount_ranges": _features(goldsets.amount_ranges),
    "correlation": _features(goldsets.correlation),
    "fraud_samples": _features(goldsets.fraud_samples),
    "class_counts": _features(goldsets.class_counts),
    "overall_fraud_rate": _features(goldsets.overall_fraud_rate),
    "feature_quality": _pair(unified.feature_quality),
    "prediction_accuracy": _pair(unified.prediction_accuracy),
    "freshness": lambda spark, as_of: unified.freshness(_dated(spark), as_of),
    "dataset_counts": _features(goldsets.dataset_counts),
    "dataset_compare": _features(goldsets.dataset_compare),
    "fraud_summary": lambda spark, as_of: goldsets.fraud_summary(spark.table("fraud_detection_summary")),
}


def query(spark: SparkSession, lake: str, name: str, as_of: Column | None = None) -> DataFrame:
    """Register the lake and run one of its queries."""
    register(spark, lake)
    return QUERIES[name](spark, F.current_timestamp().cast("timestamp_ntz") if as_of is None else as_of)
