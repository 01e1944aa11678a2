"""Medians per group are exact at sizes where sketches are not."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from txnlake.operators import gold, scale, silver
from txnlake.streaming import windows

ROWS = 200_000


@pytest.fixture(scope="module")
def rows(spark):
    """Two groups of 100,000 rows; amounts are a permutation of 0 .. 199,999."""
    i = F.col("id")
    return spark.range(0, ROWS, 1, 8).select(
        (i % 2).cast("int").alias("Hour"),
        F.lit(0).alias("IsWeekend"),
        ((i % 2) * 3600).cast("double").alias("Time"),
        ((i * 77_773) % ROWS).cast("double").alias("Amount"),
        F.lit(0).alias("Class"),
        F.lit(1.0).alias("DataQuality_Score"),
    )


def _want(rows):
    out = {}
    for hour, amount in rows.select("Hour", "Amount").toPandas().itertuples(index=False):
        out.setdefault(hour, []).append(amount)
    return {h: sorted(xs)[(len(xs) - 1) // 2] for h, xs in out.items()}


def test_gold_hours_have_exact_medians(rows):
    want = _want(rows)
    assert {r["Hour"]: r["median_amount"] for r in gold.hourly(rows).collect()} == want
    stamp = F.lit("2024-01-31").cast("timestamp_ntz")
    assert {r["Hour"]: r["median_amount"] for r in gold.hourly_no_time(rows, stamp).collect()} == want


def test_event_time_hours_have_exact_medians(rows):
    stream = rows.select(
        F.timestamp_seconds("Time").alias("time_stamp"),
        F.col("Amount").alias("amount"),
        F.col("Class").alias("fraud_class"),
        F.col("DataQuality_Score").alias("data_quality_score"),
    )
    got = {r["timestamp"].hour: r["median_amount"] for r in windows.hourly(stream).collect()}
    assert got == _want(rows)


def test_medians_of_null_keys_empty_groups_and_even_counts(spark):
    df = spark.createDataFrame(
        [(None, 3.0), (None, 1.0), (1, 2.0), (1, 8.0), (1, 8.0), (1, 1.0), (2, None)], "k int, x double"
    )
    groups = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = {r["k"]: (r["n"], r["m"]) for r in scale.with_group_median(groups, df, ["k"], "x", "m").collect()}
    assert got == {None: (2, 1.0), 1: (4, 2.0), 2: (1, None)}


def test_quartile_flags_are_exact(rows):
    """Fences lie between neighbouring values: a quartile off by one rank moves a flag."""
    x = F.col("Amount")
    far = rows.select(F.when(x < 50_000, x - 250_000).when(x > 149_999, x + 250_000).otherwise(x).alias("x"))
    quartiles = far.selectExpr(
        "percentile_disc(0.25) WITHIN GROUP (ORDER BY x) AS a", "percentile_disc(0.75) WITHIN GROUP (ORDER BY x) AS b"
    ).first()
    got = {r["prob"]: r["value"] for r in scale.exact_quantiles(far, {"x": F.col("x")}, [0.25, 0.75], discrete=True).collect()}
    assert got == {0.25: quartiles["a"], 0.75: quartiles["b"]}
    spread = 1.5 * (quartiles["b"] - quartiles["a"])
    want = far.where((F.col("x") < quartiles["a"] - spread) | (F.col("x") > quartiles["b"] + spread)).count()
    assert silver.outlier_iqr(far, ["x"]).agg(F.sum("x_IsOutlier")).first()[0] == want


def test_quartile_flags_have_no_digest_in_one_task(rows):
    plan = silver.outlier_iqr(rows, ["Amount"])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "Aggregate" not in plan
