"""Profiles of silver and gold tables as small tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.functions.components import unpivoted
from txnlake.operators import scale
from txnlake.operators.ml import flag_columns
from txnlake.operators.quality import component_columns, features_present
from txnlake.schemas import HOURLY_EXPECTED, SILVER_EXPECTED

_NUMBERS = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType)
TOP_VALUES = 5


def _metric(section: str, item: str, value: Column) -> Column:
    return F.struct(F.lit(section).alias("metric"), F.lit(item).alias("item"), value.cast("double").alias("value"))


def dataset(df: DataFrame, **limits) -> DataFrame:
    """Per column: type, rows, nulls with share; for numbers also count, mean, deviation and quartiles."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMBERS)]
    others = [c for c in df.columns if c not in numbers]
    rows, nulls = F.count(F.lit(1)), F.count_if(F.col("value").isNull())
    head = [rows.alias("rows"), nulls.alias("nulls"), (nulls / rows * 100).alias("null_percent")]
    stats = (
        unpivoted(df, numbers)
        .groupBy("column")
        .agg(
            *head,
            F.avg("value").alias("mean"),
            F.stddev("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    if others:
        plain = unpivoted(df, others, kind="STRING").groupBy("column").agg(*head)
        stats = stats.unionByName(plain, allowMissingColumns=True)
    quartiles = scale.exact_quantiles(df, {c: F.col(c) for c in numbers}, [0.25, 0.5, 0.75], **limits)
    # At most one row per column of the schema.
    wide = (
        quartiles.groupBy("series")
        .pivot("prob", [0.25, 0.5, 0.75])
        .agg(F.first("value"))
        .toDF("column", "q25", "q50", "q75")
    )
    types = df.sparkSession.createDataFrame(df.dtypes, "column string, type string")
    return (
        types.join(stats, "column", "left")
        .join(wide, "column", "left")
        .select("column", "type", "rows", "nulls", "null_percent", "mean", "std", "min", "q25", "q50", "q75", "max")
    )


def categorical(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct values and the five most frequent ones of every text column."""
    text = list(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    counts = unpivoted(df, text, kind="STRING").where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    distinct = counts.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
    w = Window.partitionBy("column").orderBy(F.desc("count"), "value")
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= TOP_VALUES)
    return top.join(distinct, "column").select("column", "distinct_values", "rank", "value", "count")


def silver_features(df: DataFrame, expected: Sequence[str] = SILVER_EXPECTED) -> DataFrame:
    return features_present(df, expected)


def silver_quality(df: DataFrame) -> DataFrame:
    """Missing cells, duplicate rows, label counts and shares, from one grouping over whole rows."""
    missing = " + ".join(f"IF(`{c}` IS NULL, 1, 0)" for c in df.columns)
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    cells = groups.select("_n", "Class", F.expr(missing).alias("_missing"))
    wide = cells.agg(
        F.sum("_n").alias("n"),
        F.sum(F.col("_missing") * F.col("_n")).alias("missing"),
        F.sum(F.col("_n") - 1).alias("dups"),
        F.coalesce(F.sum(F.when(F.col("Class") == 0, F.col("_n"))), F.lit(0)).alias("normal"),
        F.coalesce(F.sum(F.when(F.col("Class") == 1, F.col("_n"))), F.lit(0)).alias("fraud"),
    )
    rows = [
        _metric("missing_values", "*", F.col("missing")),
        _metric("duplicate_records", "*", F.col("dups")),
        _metric("label_count", "normal", F.col("normal")),
        _metric("label_count", "fraud", F.col("fraud")),
        _metric("label_percent", "normal", F.col("normal") / F.col("n") * 100),
        _metric("label_percent", "fraud", F.col("fraud") / F.col("n") * 100),
    ]
    return wide.select(F.inline(F.array(*rows)))


def _shares(counts: DataFrame, key: str, prefix: str) -> DataFrame:
    """Rows ``(metric, item, value)`` for counts and shares of a table with few rows."""
    shared = scale.with_scalar(counts, counts.agg(F.sum("n")), "total")
    pairs = F.inline(
        F.array(
            F.struct(F.lit(f"{prefix}_count").alias("metric"), F.col(key).cast("string").alias("item"), F.col("n").cast("double").alias("value")),
            F.struct(F.lit(f"{prefix}_percent").alias("metric"), F.col(key).cast("string").alias("item"), (F.col("n") / F.col("total") * 100).alias("value")),
        )
    )
    return shared.select(pairs)


def silver_amount(df: DataFrame, **limits) -> DataFrame:
    wide = df.agg(F.min("Amount").alias("lo"), F.max("Amount").alias("hi"), F.avg("Amount").alias("mean"))
    basics = wide.select(
        F.inline(F.array(*[_metric("amount", n, F.col(c)) for n, c in (("min", "lo"), ("max", "hi"), ("mean", "mean"))]))
    )
    median = scale.exact_quantiles(df, {"Amount": F.col("Amount")}, [0.5], **limits).select(
        F.lit("amount").alias("metric"), F.lit("median").alias("item"), "value"
    )
    counts = df.groupBy("Amount_Category").agg(F.count(F.lit(1)).alias("n"))
    return basics.unionByName(median).unionByName(_shares(counts, "Amount_Category", "category"))


def silver_time(df: DataFrame) -> DataFrame:
    hours = df.agg(F.min("Hour").alias("lo"), F.max("Hour").alias("hi")).select(
        F.inline(F.array(_metric("hour", "min", F.col("lo")), _metric("hour", "max", F.col("hi"))))
    )
    day_kind = F.when(F.col("IsWeekend") == 1, "weekend").otherwise("weekday")
    counts = df.groupBy(day_kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return hours.unionByName(_shares(counts, "kind", "day"))


def silver_outliers(df: DataFrame) -> DataFrame:
    flags = flag_columns(df)
    total = F.expr(f"sum({' + '.join(flags)})") if flags else F.lit(0)
    return df.agg(
        F.lit(len(component_columns(df))).alias("components"),
        F.lit(len(flags)).alias("flag_columns"),
        total.cast("long").alias("total_flags"),
    )


def silver_processing(df: DataFrame) -> DataFrame:
    return df.agg(F.max("ProcessedTimestamp").alias("last_processed"), F.avg("DataQuality_Score").alias("avg_quality"))


def bronze_silver_diff(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    added = sorted(set(silver.columns) - set(bronze.columns))
    rows = scale.with_scalar(silver.agg(F.count(F.lit(1)).alias("silver_rows")), bronze.agg(F.count(F.lit(1))), "bronze_rows")
    return rows.select(
        "bronze_rows",
        "silver_rows",
        (F.col("bronze_rows") - F.col("silver_rows")).alias("removed_rows"),
        F.lit(len(bronze.columns)).alias("bronze_columns"),
        F.lit(len(silver.columns)).alias("silver_columns"),
        F.lit(len(added)).alias("new_columns"),
        F.lit(",".join(added)).alias("added"),
    )


def _names(cols: Sequence[str]) -> dict[str, str]:
    """Names without case and underscores, so that ``IsWeekend`` is ``is_weekend``."""
    return {c.lower().replace("_", ""): c for c in cols}


def hourly(df: DataFrame, expected: Sequence[str] = HOURLY_EXPECTED) -> DataFrame:
    have, want = _names(df.columns), _names(expected)
    return df.agg(
        F.lit(",".join(want[k] for k in want if k not in have)).alias("missing_columns"),
        F.lit(",".join(have[k] for k in have if k not in want)).alias("extra_columns"),
        F.count(F.lit(1)).alias("records"),
        F.min("Hour").alias("min_hour"),
        F.max("Hour").alias("max_hour"),
        F.min("fraud_rate").alias("min_fraud_rate"),
        F.max("fraud_rate").alias("max_fraud_rate"),
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("fraud_count").alias("total_frauds"),
        (F.sum("fraud_count") / F.sum("total_transactions")).alias("overall_fraud_rate"),
        F.min("timestamp").alias("min_time"),
        F.max("timestamp").alias("max_time"),
    )


def ml(sets: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in sets.items():
        cycles = [c for c in df.columns if c.endswith(("_Sin", "_Cos"))]
        one = df.agg(
            F.lit(name).alias("dataset"),
            F.count(F.lit(1)).alias("rows"),
            F.lit(len(df.columns)).alias("features"),
            F.avg(F.col("Class").cast("double")).alias("fraud_rate"),
            F.count_if(F.col("Class") == 1).alias("fraud_cases"),
            F.count_if(F.col("Class") == 0).alias("normal_cases"),
            F.lit(len([c for c in df.columns if "Interaction" in c])).alias("interaction_features"),
            F.lit(len(cycles)).alias("cyclic_features"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def risk(profiles: DataFrame) -> DataFrame:
    """Segments, categories, score range and the five highest scores as ``(metric, item, value)``."""
    basics = profiles.agg(
        F.count(F.lit(1)).alias("n"), F.min("risk_score").alias("lo"), F.max("risk_score").alias("hi")
    ).select(
        F.inline(
            F.array(
                _metric("segments", "total", F.col("n")), _metric("risk_score", "min", F.col("lo")), _metric("risk_score", "max", F.col("hi"))
            )
        )
    )
    categories = profiles.groupBy("risk_category").agg(F.count(F.lit(1)).cast("double").alias("value"))
    top = profiles.orderBy(F.desc("risk_score"), "account_id").limit(5)
    return (
        basics.unionByName(categories.select(F.lit("category").alias("metric"), F.col("risk_category").alias("item"), "value"))
        .unionByName(top.select(F.lit("top_score").alias("metric"), F.col("account_id").cast("string").alias("item"), F.col("risk_score").alias("value")))
    )


def summary(stats: DataFrame) -> DataFrame:
    return stats.groupBy("aggregation_level").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.avg("fraud_rate").alias("avg_fraud_rate"),
    )


def as_report(section: str, df: DataFrame) -> DataFrame:
    """Any small result as rows ``(section, item, value)``; several rows are told apart by their first column."""
    first = F.col(df.columns[0]).cast("string")
    parts = [
        F.struct(F.concat_ws(".", first, F.lit(c)).alias("item"), F.col(c).cast("string").alias("value")) for c in df.columns
    ]
    return df.select(F.lit(section).alias("section"), F.inline(F.array(*parts)))


def gold_report(sections: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in sections.items():
        rows = as_report(name, df)
        out = rows if out is None else out.unionByName(rows)
    return out
