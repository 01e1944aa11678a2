"""Silver to gold: hourly aggregates, risk profiles, summary statistics, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions import timing
from txnlake.functions.amount import amount_category
from txnlake.operators import ml, scale
from txnlake.schemas import HOURLY_COLS

# Kept days per data set.
RETENTION_DAYS = {"fraud_analytics_hourly": 90, "ml_features": 365, "risk_profiles": 730, "summary_stats": 730}


def default_columns(df: DataFrame) -> DataFrame:
    """Add the grouping columns a silver table may lack."""
    defaults = {"Hour": F.lit(0), "IsWeekend": F.lit(0), "Amount_Category": F.lit("Unknown")}
    return df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})


def _measures() -> list[Column]:
    return [
        F.sum("Class").cast("long").alias("fraud_count"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("Amount").alias("total_amount"),
        F.avg("Amount").alias("avg_amount"),
        F.stddev("Amount").alias("std_amount"),
        F.avg("DataQuality_Score").alias("avg_data_quality"),
    ]


MEASURES = [
    "fraud_count",
    "total_transactions",
    "total_amount",
    "avg_amount",
    "median_amount",
    "std_amount",
    "avg_data_quality",
]


def _measured(df: DataFrame, keys: list[str], extra: tuple[Column, ...]) -> DataFrame:
    """The measures per group; the median is exact, whatever the size of a group."""
    groups = df.groupBy(*keys).agg(*_measures(), *extra)
    extras = [c for c in groups.columns if c not in (*keys, *MEASURES)]
    return scale.with_group_median(groups, df, keys, "Amount", "median_amount").select(*keys, *MEASURES, *extras)


def hour_of_offset(time: Column) -> Column:
    """Start of the hour of a seconds offset, as a timestamp counted from 1970."""
    return F.date_trunc("hour", timing.seconds_to_ntz(time).cast("timestamp")).cast("timestamp_ntz")


def hourly(df: DataFrame, *extra: Column) -> DataFrame:
    """Hourly measures by time, ``Hour`` and ``IsWeekend``."""
    df = default_columns(df)
    return _measured(df.withColumn("timestamp", hour_of_offset(F.col("Time"))), ["timestamp", "Hour", "IsWeekend"], extra)


def hourly_no_time(df: DataFrame, as_of: Column, *extra: Column) -> DataFrame:
    """The same measures for a table without time: grouped by ``Hour`` and stamped ``as_of``."""
    df = default_columns(df)
    grouped = _measured(df, ["Hour", "IsWeekend"], extra)
    return grouped.select(as_of.alias("timestamp"), *grouped.columns)


def with_fraud_rate(hours: DataFrame, data_version: str, created_at: Column | None = None) -> DataFrame:
    hours = hours.withColumn("fraud_rate", F.col("fraud_count") / F.col("total_transactions"))
    if "created_at" not in hours.columns:
        stamp = F.current_timestamp() if created_at is None else created_at
        hours = hours.withColumn("created_at", stamp.cast("timestamp_ntz"))
    return hours.withColumn("data_version", F.lit(data_version))


def build_hourly(silver: DataFrame, data_version: str, created_at: Column | None = None) -> DataFrame:
    """The hourly gold table. ``created_at`` may be an aggregate such as ``max(ts)``; default is the clock."""
    extra = [] if created_at is None else [created_at.alias("created_at")]
    return with_fraud_rate(hourly(silver, *extra), data_version).select(*HOURLY_COLS)


def time_range(hours: DataFrame) -> DataFrame:
    return hours.agg(
        F.lit("fraud_analytics").alias("dataset"),
        F.count(F.lit(1)).alias("records"),
        F.min("timestamp").alias("min_ts"),
        F.max("timestamp").alias("max_ts"),
    )


def hourly_compact(df: DataFrame, ts: Column) -> DataFrame:
    window = F.date_trunc("hour", ts.cast("timestamp")).cast("timestamp_ntz")
    frauds = F.count_if(F.col("Class") == 1)
    return df.groupBy(window.alias("hour_window")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        frauds.alias("fraud_transactions"),
        (frauds / F.count(F.lit(1))).alias("fraud_rate"),
        F.sum("Amount").alias("total_amount"),
        F.avg("Amount").alias("avg_amount"),
        F.max("Amount").alias("max_amount"),
    )


def amount_category_counts(df: DataFrame) -> DataFrame:
    """Rows per hour and amount category (long form)."""
    df = default_columns(df)
    return df.groupBy(hour_of_offset(F.col("Time")).alias("timestamp"), "Amount_Category").agg(
        F.count(F.lit(1)).alias("transactions")
    )


def amount_category_dist(df: DataFrame) -> DataFrame:
    """One map per hour; an hour has at most five categories."""
    return (
        amount_category_counts(df)
        .groupBy("timestamp")
        .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("Amount_Category", "transactions")))).alias("amount_category_dist"))
    )


def with_amount_categories(hours: DataFrame, silver: DataFrame) -> DataFrame:
    """The hourly table with its counts per amount category; both sides have one row per hour or few."""
    counts = amount_category_dist(silver).withColumnRenamed("timestamp", "_hour")
    return hours.join(counts, F.col("timestamp").eqNullSafe(F.col("_hour")), "left").drop("_hour")


# Our definition of the customer risk profile.
RISK_WEIGHTS = {"fraud": 0.5, "outliers": 0.3, "amount": 0.2}
RISK_CATEGORIES = ((0.15, "Low"), (0.3, "Medium"), (0.6, "High"))
AMOUNT_SCALE = 1000.0


def risk_profiles(silver: DataFrame) -> DataFrame:
    """Per account: activity, fraud rate, mean outlier ratio, a score in [0, 1], its category, a segment.

    score = 0.5 x fraud rate + 0.3 x mean outlier ratio + 0.2 x min(mean amount / 1000, 1). The
    segment is the amount category of the mean amount. Rows without an account are profiled together
    per amount category, with a null account: a raw card file has no accounts.
    """
    base = ml.outlier_ratio(silver)
    unknown = F.when(F.col("account_id").isNull(), amount_category(F.col("Amount")))
    per_account = base.groupBy(F.col("account_id"), unknown.alias("_segment")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.avg("Amount").alias("avg_amount"),
        F.avg(F.col("Class").cast("double")).alias("fraud_rate"),
        F.avg("Outlier_Ratio").alias("avg_outlier_ratio"),
    )
    score = (
        F.lit(RISK_WEIGHTS["fraud"]) * F.col("fraud_rate")
        + F.lit(RISK_WEIGHTS["outliers"]) * F.col("avg_outlier_ratio")
        + F.lit(RISK_WEIGHTS["amount"]) * F.least(F.col("avg_amount") / F.lit(AMOUNT_SCALE), F.lit(1.0))
    )
    scored = per_account.withColumn("risk_score", score)
    category = None
    for bound, name in RISK_CATEGORIES:
        hit = F.col("risk_score") < bound
        category = F.when(hit, name) if category is None else category.when(hit, name)
    segment = F.coalesce("_segment", amount_category(F.col("avg_amount")))
    return scored.withColumns({"risk_category": category.otherwise("Critical"), "customer_segment": segment}).drop("_segment")


GRAINS = (("daily", "day"), ("weekly", "week"), ("monthly", "month"))


def summary_stats(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Daily, weekly and monthly statistics.

    The rows are folded to days once; weeks and months are sums of days.
    """
    day = F.to_date(F.col(ts))
    days = df.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("Class") == 1).alias("f"),
        F.sum("Amount").alias("a"),
        F.count("Amount").alias("c"),
        F.max("Amount").alias("m"),
    )
    grains = F.inline(
        F.array(
            *[
                F.struct(F.lit(level).alias("aggregation_level"), F.trunc("day", unit).alias("date"))
                if unit != "day"
                else F.struct(F.lit(level).alias("aggregation_level"), F.col("day").alias("date"))
                for level, unit in GRAINS
            ]
        )
    )
    return (
        days.select("n", "f", "a", "c", "m", grains)
        .groupBy("aggregation_level", "date")
        .agg(
            F.sum("n").alias("total_transactions"),
            F.sum("f").alias("fraud_count"),
            (F.sum("f") / F.sum("n")).alias("fraud_rate"),
            F.sum("a").alias("total_amount"),
            F.try_divide(F.sum("a"), F.sum("c")).alias("avg_amount"),
            F.max("m").alias("max_amount"),
        )
    )


def retain(df: DataFrame, ts: str, as_of: Column, days: int) -> DataFrame:
    """Rows not older than ``days`` at ``as_of``."""
    return since(df, ts, as_of - F.make_dt_interval(F.lit(days)))


def since(df: DataFrame, ts: str, first: Column) -> DataFrame:
    """Rows from ``first`` on: a plain comparison, which reaches the scan, and on a table partitioned by
    the ``day`` of ``ts`` one on the day too, which leaves out whole folders."""
    rows = df.where(F.col(ts) >= first)
    return rows.where(F.col("day") >= F.to_date(first)) if "day" in df.columns else rows
