"""Machine-learning feature sets and their repeatable split."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions import components as comp
from txnlake.functions import timing
from txnlake.functions.hashing import key_hash
from txnlake.operators import scale
from txnlake.schemas import ML_BASE

FLAG_SUFFIX = "_IsOutlier"
CARRIED = ("id", "account_id", "ts", "Time", "Amount")
ROLLING_ROWS = 100
FEATURE_VERSION = "1.0"
SPLIT_SEED = 42
TRAIN_TENTHS = 8


def flag_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith(FLAG_SUFFIX)]


def select_features(df: DataFrame, carried: Sequence[str] = CARRIED) -> DataFrame:
    """Base features and outlier flags; an absent feature becomes 0.

    The key, time and amount columns come along, since the analytic queries need them.
    """

    def feature(c: str) -> Column:
        if c in df.columns:
            return F.col(c)
        return (F.lit(0) if c == "Class" else F.lit(0.0)).alias(c)

    return df.select(*[c for c in carried if c in df.columns], *[feature(c) for c in ML_BASE], *flag_columns(df))


def interactions(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{v}_Amount_Interaction": F.col(v) * F.col("Amount_Log") for v in ("V1", "V2")})


def cyclic(df: DataFrame) -> DataFrame:
    out = {}
    for c, period in (("Hour", 24.0), ("DayOfWeek", 7.0)):
        out[f"{c}_Sin"] = timing.cyclic_sin(F.col(c), period)
        out[f"{c}_Cos"] = timing.cyclic_cos(F.col(c), period)
    return df.withColumns(out)


ROLLING = {"Amount_Rolling_Mean": "mean", "Amount_Rolling_Std": "std"}


def rolling_100(df: DataFrame, **limits) -> DataFrame:
    """Mean and population deviation of the account's last 100 amounts, by time."""
    return scale.rolling(df, ["account_id"], ["Time", "id"], ROLLING_ROWS, "Amount_Log", ROLLING, **limits)


def rolling_100_global(df: DataFrame, **limits) -> DataFrame:
    """The same over the whole table."""
    return scale.rolling(df, [], ["Time", "id"], ROLLING_ROWS, "Amount_Log", ROLLING, **limits)


def outlier_ratio(df: DataFrame) -> DataFrame:
    """Share of the row's outlier flags; without flags the first five components beyond 3; else 0."""
    flags = flag_columns(df)
    if flags:
        ratio = comp.flag_share(flags)
    else:
        present = [c for c in ("V1", "V2", "V3", "V4", "V5") if c in df.columns]
        ratio = comp.outlier_share(present) if present else F.lit(0.0)
    return df.withColumn("Outlier_Ratio", ratio)


def metadata(df: DataFrame, created_at: Column | None = None, source: str = "silver_layer") -> DataFrame:
    return df.withColumns(
        {
            "feature_version": F.lit(FEATURE_VERSION),
            "created_at": (F.current_timestamp() if created_at is None else created_at).cast("timestamp_ntz"),
            "data_source": F.lit(source),
        }
    )


def build(
    silver: DataFrame,
    rolling: str | None = "account",
    created_at: Column | None = None,
    row_key: str | None = None,
    deal: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The feature table; ``rolling`` is ``account``, ``global`` or None.

    ``row_key`` names a column that no two rows share (see :func:`scale.rolling`). ``deal`` may place the rows before they get the
    columns derived from them, and add columns.
    """
    base = select_features(silver)
    df = base
    if rolling == "account":
        df = rolling_100(df, row_key=row_key)
    elif rolling == "global":
        df = rolling_100_global(df, row_key=row_key)
    framed = [c for c in df.columns if c not in base.columns]
    if deal:
        df = deal(df)
    added = [c for c in df.columns if c not in (*base.columns, *framed)]
    wide = cyclic(interactions(df))
    derived = [c for c in wide.columns if c not in df.columns]
    full = metadata(outlier_ratio(wide.select(*base.columns, *derived, *framed, *added)), created_at)
    return full.select(*[c for c in full.columns if c not in added], *added)


def in_train(key: Column, seed: int = SPLIT_SEED, tenths: int = TRAIN_TENTHS) -> Column:
    """Repeatable split by a hash of the key: the same row always falls on the same side."""
    return key_hash(key, seed) % 10 < tenths


def with_split(df: DataFrame, seed: int = SPLIT_SEED, tenths: int = TRAIN_TENTHS) -> DataFrame:
    side = F.when(in_train(F.col("id"), seed, tenths), F.lit("train")).otherwise(F.lit("test"))
    return df.withColumn("split", side)


def train_test(df: DataFrame, seed: int = SPLIT_SEED, tenths: int = TRAIN_TENTHS) -> tuple[DataFrame, DataFrame]:
    train = in_train(F.col("id"), seed, tenths)
    return df.where(train), df.where(~train)


def split_counts(df: DataFrame) -> DataFrame:
    """Total, train and test rows and the number of feature columns, from one pass."""
    train = in_train(F.col("id"))
    return df.agg(
        F.lit("ml_features").alias("dataset"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(train).alias("train_records"),
        F.count_if(~train).alias("test_records"),
        F.lit(len(df.columns)).alias("feature_count"),
    )
