"""The stream feature record, as one set of column expressions for batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions import amount as amt
from txnlake.functions import components as comp
from txnlake.functions import scoring, timing
from txnlake.operators import scale
from txnlake.schemas import V_COLS

COMPONENTS = [c.lower() for c in V_COLS]
FEATURE_VERSION = "1.0"
DATA_SOURCE = "stream_layer"
ROLLING_ROWS = 100
ROLLING_COLS = [
    "amount_rolling_mean",
    "amount_rolling_std",
    "amount_rolling_min",
    "amount_rolling_max",
    "transaction_velocity",
]
RECORD_COLS = [
    "transaction_id",
    "account_id",
    "time_stamp",
    *COMPONENTS,
    "amount",
    "amount_log",
    "amount_percentile",
    "amount_zscore",
    "hour",
    "day_of_week",
    "is_weekend",
    "hour_sin",
    "hour_cos",
    "day_of_week_sin",
    "day_of_week_cos",
    *[f"v{i}_amount_interaction" for i in range(1, 6)],
    "outlier_ratio",
    "data_quality_score",
    "pca_mean",
    "pca_std",
    "pca_skewness",
    "pca_kurtosis",
    "amount_range_flag",
    "time_cluster",
    "risk_score",
    "is_anomaly",
    "fraud_class",
    "feature_version",
    "created_at",
    "processed_at",
    "data_source",
]


def clean_components(df: DataFrame) -> DataFrame:
    """Components as doubles, null as 0."""
    return df.withColumns({c: F.expr(f"coalesce(try_cast({c} AS DOUBLE), 0D)") for c in COMPONENTS})


def amount_features(df: DataFrame) -> DataFrame:
    clean = df.withColumn("amount", F.coalesce(F.col("amount").try_cast("double"), F.lit(0.0)))
    return clean.withColumn("amount_log", amt.amount_log(F.col("amount")))


def interactions(df: DataFrame) -> DataFrame:
    return df.withColumns({f"v{i}_amount_interaction": F.col(f"v{i}") * F.col("amount_log") for i in range(1, 6)})


def feature_record(
    df: DataFrame,
    processed_at: Column,
    created_at: Column | None = None,
    stats: bool = True,
    carried: Sequence[str] = (),
) -> DataFrame:
    """All per-row stream features.

    Input: ``id, account_id, v1..v28, amount, class`` as received, ``created`` (event time) and
    ``created_present``. ``created_at`` defaults to the processing time. ``stats=False`` leaves out
    the four component statistics for consumers that do not read them; ``carried`` names columns that come along.
    """
    # The quality score sees values as received, so it comes before nulls are replaced.
    scored = df.withColumn("data_quality_score", scoring.data_quality_score("amount", COMPONENTS))
    clean = amount_features(clean_components(scored))
    amount = F.col("amount")
    timed = clean.withColumns(
        {
            **timing.stream_time_features(F.col("created"), F.col("created_present")),
            "amount_percentile": amt.amount_percentile_step(amount),
            "amount_zscore": amt.amount_zscore(amount),
            "amount_range_flag": amt.amount_range_flag(amount),
            "outlier_ratio": comp.outlier_share(COMPONENTS),
        }
    )
    full = interactions(timed)
    if stats:
        full = comp.with_component_stats(full, COMPONENTS)
    out = full.withColumns(
        {
            "risk_score": scoring.risk_score(
                amount, F.col("time_cluster"), F.col("is_weekend"), F.col("outlier_ratio"), F.col("data_quality_score")
            ),
            "is_anomaly": scoring.is_anomaly(F.col("outlier_ratio")),
            "transaction_id": F.col("id"),
            "time_stamp": F.col("created"),
            "fraud_class": F.col("class"),
            "feature_version": F.lit(FEATURE_VERSION),
            "data_source": F.lit(DATA_SOURCE),
            "processed_at": processed_at.cast("timestamp_ntz"),
            "created_at": (processed_at if created_at is None else created_at).cast("timestamp_ntz"),
        }
    )
    return out.select(*[c for c in RECORD_COLS if stats or not c.startswith("pca_")], *carried)


def with_rolling(df: DataFrame, **limits) -> DataFrame:
    """Batch form of the rolling state: the account's last 100 records by event time."""
    kinds = dict(zip(ROLLING_COLS, ("mean", "std", "min", "max", "rows")))
    framed = scale.rolling(df, ["account_id"], ["time_stamp", "transaction_id"], ROLLING_ROWS, "amount_log", kinds, **limits)
    return framed.withColumn("transaction_velocity", F.col("transaction_velocity") / F.lit(5.0))


def json_lines(df: DataFrame) -> DataFrame:
    """One JSON text per record, nulls kept."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json_data"))


def alerts(df: DataFrame) -> DataFrame:
    """Records to raise: risk above 0.8, or anomalous."""
    return df.where(scoring.is_alert(F.col("risk_score"), F.col("is_anomaly")))
