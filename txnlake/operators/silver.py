"""Bronze to silver: cleaning, imputation and row features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.functions import amount as amt
from txnlake.functions import components as comp
from txnlake.functions import timing
from txnlake.functions.hashing import in_share
from txnlake.operators import scale
from txnlake.schemas import V_COLS
from txnlake.session import materialize

# Fixed values; the steps are those every run takes, in order.
DEFAULT_AMOUNT = 22.0
DEFAULT_OTHER = 0.0
FLAGGED = V_COLS[:5]
OUTLIER_LOW, OUTLIER_HIGH = -3.0, 3.0
IQR_FACTOR = 1.5
SAMPLE_SHARE, SAMPLE_SEED = 0.1, 42
STEPS = (
    "duplicate_removal",
    "missing_value_handling",
    "feature_engineering",
    "outlier_detection",
    "data_quality_scoring",
)

_NUMERIC = (T.DoubleType, T.FloatType, T.DecimalType, T.IntegerType, T.LongType)
# Never imputed: the label, the time, and the keys.
NOT_FILLED = ("Class", "Time", "id", "account_id")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC) and f.name not in NOT_FILLED]


def sample(df: DataFrame, share: float = SAMPLE_SHARE, key: str = "id") -> DataFrame:
    """A repeatable share of the keys, with all rows of each."""
    return df.where(in_share(F.col(key), share, SAMPLE_SEED))


def dedup(df: DataFrame) -> DataFrame:
    """Drop exact copies. Copies are folded before the shuffle, so a large group costs no more."""
    return df.dropDuplicates()


def duplicate_counts(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and removed rows in one grouping."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates_removed"),
    )


def fill_missing(df: DataFrame) -> DataFrame:
    """Nulls of numeric columns become fixed values; label and time stay as they are."""
    decimals = {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    if decimals:
        df = df.withColumns(decimals)
    return df.fillna({c: DEFAULT_AMOUNT if c == "Amount" else DEFAULT_OTHER for c in numeric_columns(df)})


def fill_median(df: DataFrame, cols: Sequence[str] | None = None, accuracy: int = 10_000) -> DataFrame:
    """Nulls become the column's median, all medians from one pass."""
    cols = list(cols or numeric_columns(df))
    medians = df.agg(F.struct(*[F.percentile_approx(c, 0.5, accuracy).alias(c) for c in cols]))
    filled = scale.with_scalar(df, medians, "_medians")
    return filled.withColumns({c: F.coalesce(c, f"_medians.{c}") for c in cols}).drop("_medians")


def time_cast(df: DataFrame) -> DataFrame:
    return df.withColumn("Time", F.col("Time").cast("double"))


def amount_log(df: DataFrame) -> DataFrame:
    return df.withColumn("Amount_Log", amt.amount_log(F.col("Amount").cast("double")))


def amount_category(df: DataFrame) -> DataFrame:
    return df.withColumn("Amount_Category", amt.amount_category(F.col("Amount")))


def row_fraction(df: DataFrame, order: Sequence[str] = ("id",), name: str = "Row_Fraction") -> DataFrame:
    """Place of the row, from 0, divided by the number of rows, in a fixed order."""
    numbered = scale.global_row_number(df, list(order), "_rn", total="_rows")
    return numbered.withColumn(name, (F.col("_rn") - 1).cast("double") / F.col("_rows")).drop("_rn", "_rows")


def amount_percentile(df: DataFrame, name: str = "Amount_Percentile") -> DataFrame:
    return scale.percent_rank(df, "Amount", name)


def time_features(df: DataFrame) -> DataFrame:
    time = F.col("Time")
    day = timing.offset_day(time)
    return df.withColumns(
        {"Hour": timing.offset_hour(time), "DayOfWeek": day, "IsWeekend": timing.is_weekend(day)}
    )


def outlier_fixed(df: DataFrame, cols: Sequence[str] = FLAGGED) -> DataFrame:
    return df.withColumns(
        {f"{c}_IsOutlier": comp.is_outlier(F.col(c), F.lit(OUTLIER_LOW), F.lit(OUTLIER_HIGH)) for c in cols}
    )


def outlier_iqr(df: DataFrame, cols: Sequence[str] = V_COLS) -> DataFrame:
    """Flags outside the quartiles by more than 1.5 interquartile ranges.

    The quartiles are exact values of their columns (``percentile_disc``; NaN left out), found in three scans for all columns, so ``df``
    is better a stored table. They are constants of the plan, two per column.
    """
    found = scale.exact_quantiles(df, {c: F.col(c) for c in cols}, [0.25, 0.75], discrete=True).collect()
    quartiles = {(r["series"], r["prob"]): r["value"] for r in found}

    def flag(c: str) -> Column:
        low, high = (F.lit(quartiles.get((c, p))).cast("double") for p in (0.25, 0.75))
        spread = F.lit(IQR_FACTOR) * (high - low)
        return ((F.col(c) < low - spread) | (F.col(c) > high + spread)).cast("int")

    return df.withColumns({f"{c}_IsOutlier": flag(c) for c in cols})


def metadata(
    df: DataFrame,
    sample_size: Column | int,
    total: Column | int,
    mode: str = "FULL",
    processed_at: Column | None = None,
) -> DataFrame:
    def as_column(x):
        return x if isinstance(x, Column) else F.lit(x)

    return df.withColumns(
        {
            "ProcessedTimestamp": (F.current_timestamp() if processed_at is None else processed_at).cast("timestamp_ntz"),
            "DataQuality_Score": F.lit(1.0),
            "ProcessingMode": F.lit(mode),
            "SampleSize": as_column(sample_size).cast("long"),
            "OriginalTotalRecords": as_column(total).cast("long"),
        }
    )


def filter_label(df: DataFrame) -> DataFrame:
    return df.where(F.col("Class").isNotNull())


def cleaned(source: DataFrame) -> DataFrame:
    """Deduplicated and filled rows, written once.

    Ranks, quartiles and counts each read a column or two of it instead of repeating the shuffle of
    whole rows.
    """
    return materialize(fill_missing(dedup(source)), "silver-clean")


def build(
    bronze: DataFrame,
    percentile: bool = True,
    amount_outlier: bool = False,
    processed_at: Column | None = None,
    clean: DataFrame | None = None,
) -> DataFrame:
    """The silver table.

    ``percentile`` adds the rank by amount (a sort over the distinct amounts); ``amount_outlier``
    adds the quartile flag of the amount that the gold tables read. ``clean`` may pass the result of
    :func:`cleaned`; without either column nothing is written in between.
    """
    total = bronze.agg(F.count(F.lit(1))).scalar()
    if clean is not None:
        df = clean
    elif percentile or amount_outlier:
        df = cleaned(bronze)
    else:
        df = fill_missing(dedup(bronze))
    if amount_outlier:
        df = outlier_iqr(df, ["Amount"])
    df = amount_log(time_cast(df))
    if percentile:
        df = amount_percentile(df)
    df = outlier_fixed(time_features(amount_category(df)))
    return filter_label(metadata(df, total, total, processed_at=processed_at))


def stored_metrics(bronze: DataFrame, source: DataFrame, clean: DataFrame, silver: DataFrame, mode: str = "FULL") -> DataFrame:
    """The counts of :func:`run_metrics` from tables that are already written: four plain counts."""
    out = silver.agg(F.count(F.lit(1)).alias("final_records"))
    for df, name in ((bronze, "original_total_records"), (source, "sample_size"), (clean, "_distinct")):
        out = scale.with_scalar(out, df.agg(F.count(F.lit(1))), name)
    return _metric_columns(
        out.withColumn("duplicates_removed", F.col("sample_size") - F.col("_distinct")), mode
    )


def _metric_columns(counted: DataFrame, mode: str) -> DataFrame:
    return counted.select(
        F.lit(mode).alias("processing_mode"),
        "original_total_records",
        "sample_size",
        "final_records",
        "duplicates_removed",
        (F.col("sample_size") - F.col("final_records")).alias("records_removed"),
        F.round(F.try_divide("sample_size", "original_total_records") * 100, 2).alias("sample_percentage"),
    )


def run_metrics(bronze: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """Counts of one run: original, processed, final, duplicates, removed and processed share in %.

    ``taken``: the rows of a run over a sample."""
    source = bronze if taken is None else taken
    groups = source.groupBy(*source.columns).agg(F.count(F.lit(1)).alias("_n"))
    counted = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("sample_size"),
        F.count_if(F.col("Class").isNotNull()).alias("final_records"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates_removed"),
    )
    counted = scale.with_scalar(counted, bronze.agg(F.count(F.lit(1))), "original_total_records")
    return _metric_columns(counted, "FULL" if taken is None else "SAMPLE")


def lineage_report(checks: DataFrame, metrics: DataFrame, source: str, destination: str) -> DataFrame:
    """One long table ``(section, item, value)``: bronze checks, run counts, lineage, output names."""
    spark = checks.sparkSession
    check_rows = checks.select(
        F.lit("bronze_layer").alias("section"),
        F.concat_ws(":", "check", "column").alias("item"),
        F.concat_ws("=", F.when(F.col("passed"), "passed").otherwise("failed"), F.col("value").cast("string")).alias("value"),
    )
    metric_rows = metrics.select(*[F.col(c).cast("string").alias(c) for c in metrics.columns]).unpivot(
        [], metrics.columns, "item", "value"
    ).select(F.lit("transformation").alias("section"), "item", "value")
    fixed = [
        ("data_lineage", "source", source),
        ("data_lineage", "destination", destination),
        ("silver_layer", "filename", destination.rstrip("/").split("/")[-1]),
        *[("data_lineage", f"step_{i}", s) for i, s in enumerate(STEPS, 1)],
    ]
    return check_rows.unionByName(metric_rows).unionByName(
        spark.createDataFrame(fixed, "section string, item string, value string")
    )
