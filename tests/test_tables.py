"""Silver, gold, ML, quality and profiles on edge data."""

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from txnlake.operators import gold, ml, profile, quality, silver
from txnlake.schemas import TXN_SCHEMA, V_COLS


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], TXN_SCHEMA)


def test_fixture_holds_what_it_says(spark):
    t = fx.txn(spark, "/root/testdata/sf0.01")
    r = t.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"), F.sum("Class").alias("c"),
        F.count_if(F.col("Class").isNull()).alias("nc"), F.count_if(F.col("Amount").isNull()).alias("na"),
        F.max("Amount").alias("top"), F.count_if(F.abs("V5") > 3).alias("v5"),
    ).first()
    assert tuple(r) == (10200, 10000, 458, 22, 49, 28245.0, 2574)


def test_dedup_and_metrics(spark, sf_dir):
    t = fx.txn(spark, sf_dir)
    counts = silver.duplicate_counts(t).first()
    assert counts["rows"] == counts["distinct_rows"] + counts["duplicates_removed"] == t.count()
    m = silver.run_metrics(t, silver.sample(t)).first()
    assert 0 < m["sample_size"] < m["original_total_records"] == t.count()


def test_fill_leaves_label_time_and_keys(spark):
    row = (1, None, None, None, *[None] * 28, None, None)
    out = silver.fill_missing(spark.createDataFrame([row], TXN_SCHEMA)).first()
    assert (out["Amount"], out["V1"], out["V28"]) == (22.0, 0.0, 0.0)
    assert out["Class"] is None and out["Time"] is None and out["account_id"] is None


def test_fill_turns_decimals_to_doubles(spark):
    df = spark.createDataFrame([(None,)], "Amount decimal(10,2)")
    assert silver.fill_missing(df).first()["Amount"] == 22.0


def test_median_of_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None), (None, 3.0)], "V1 double, V2 double")
    rows = silver.fill_median(df, ["V1", "V2"]).collect()
    assert [r["V1"] for r in rows] == [None] * 3
    assert sorted(r["V2"] for r in rows) == [1.0, 1.0, 3.0]


def test_empty_input(empty):
    out = silver.build(empty, amount_outlier=True)
    assert out.count() == 0
    assert gold.build_hourly(out, "r").count() == 0
    assert ml.build(out, created_at=F.col("ts")).count() == 0
    checks = quality.evaluate(empty, quality.bronze_rules()).collect()
    assert not any(r["passed"] for r in checks if r["check"] in ("row_count_min", "amount_min", "time_nonnegative"))
    assert silver.duplicate_counts(empty).first()["duplicates_removed"] == 0
    assert silver.sample(empty).count() == 0


def test_split_is_disjoint_whole_and_repeatable(spark, sf_dir):
    rows = fx.unique_txn(spark, sf_dir).select("id")
    train, test = ml.train_test(rows)
    a, b = {r["id"] for r in train.collect()}, {r["id"] for r in test.collect()}
    assert not a & b and len(a | b) == rows.count()
    assert a == {r["id"] for r in ml.train_test(rows.repartition(13))[0].collect()}
    assert 0.75 < len(a) / (len(a) + len(b)) < 0.85


def test_outlier_ratio_without_components(spark):
    assert ml.outlier_ratio(spark.range(2)).select("Outlier_Ratio").distinct().collect()[0][0] == 0.0


def test_global_rolling_in_build(spark, sf_dir):
    rows = fx.silver_table(spark, sf_dir, percentile=False)
    out = ml.build(rows, rolling="global", created_at=F.col("ts"))
    assert out.count() == rows.count()
    assert out.where("Amount_Rolling_Mean IS NULL").count() == 0


def test_iqr_flags(spark):
    df = spark.createDataFrame([(float(x),) for x in [*range(100), 1000, -1000]], "V1 double")
    flagged = silver.outlier_iqr(df, ["V1"]).where("V1_IsOutlier = 1")
    assert sorted(r["V1"] for r in flagged.collect()) == [-1000.0, 1000.0]


def test_rules(spark, empty):
    with pytest.raises(ValueError, match="Amount"):
        quality.require_columns(empty.drop("Amount"))
    quality.require_columns(empty)
    one = silver.build(fx.txn(spark, "/root/testdata/sf0.001"), percentile=False)
    assert quality.report(quality.evaluate(one, quality.silver_rules())).first()["status"] == "PASSED"
    bad = one.withColumn("Hour", F.lit(24))
    assert quality.report(quality.evaluate(bad, quality.silver_rules())).first()["status"] == "FAILED_BUT_CONTINUING"
    assert quality.report(quality.evaluate(bad, quality.silver_rules()).limit(0)).first()["status"] == "ERROR"
    present = {r["feature"]: r["present"] for r in quality.features_present(one.drop("Hour")).collect()}
    assert present == {"Amount_Log": True, "Hour": False, "IsWeekend": True, "DataQuality_Score": True}


def test_row_bounds(spark):
    few = quality.evaluate(spark.range(999), quality.row_count_rules(high=1_000_000)).collect()
    assert [r["passed"] for r in few] == [False, True]
    assert len(quality.evaluate(spark.range(10), quality.row_count_rules(1, None)).collect()) == 1


def test_warnings_do_not_hide_failures(spark):
    df = spark.createDataFrame([(-1.0,), (None,)], "Amount double")
    rows = {r["check"]: (r["passed"], r["severity"]) for r in quality.evaluate(df, quality.amount_rules()).collect()}
    assert rows == {"amount_min": (False, "warn"), "amount_max": (True, "warn"), "amount_nulls": (False, "fail")}


def test_validation_sample_is_repeatable(spark):
    df = spark.range(20_000)
    a = {r["id"] for r in quality.validation_sample(df, 0.05).collect()}
    assert 800 < len(a) < 1200
    assert a == {r["id"] for r in quality.validation_sample(df.repartition(9), 0.05).collect()}
    assert quality.validation_sample(df, 1.0).count() == 20_000


@pytest.mark.parametrize("share", [0, -0.1, 1.1, 100, None])
def test_shares_lie_between_nothing_and_all(spark, share):
    with pytest.raises(ValueError):
        quality.validation_sample(spark.range(5), share)


def test_scores_of_perfect_rows(spark):
    df = spark.range(5).selectExpr(*[f"0D AS {c}" for c in V_COLS], "5D AS Amount", "1D AS Time", "0 AS Class")
    assert tuple(quality.scores(df).first()) == (1.0, 1.0, 1.0, 1.0)


def test_profile_names_missing_columns(spark, sf_dir):
    hours = fx.hourly_table(spark, sf_dir).drop("created_at")
    r = profile.hourly(hours).first()
    assert set(r["missing_columns"].split(",")) == {"amount_category_dist", "created_at"}


def test_category_map(spark, sf_dir):
    dist = gold.amount_category_dist(fx.silver_table(spark, sf_dir, percentile=False))
    total = dist.select(F.aggregate(F.map_values("amount_category_dist"), F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    assert total.agg(F.sum("n")).first()[0] == fx.silver_table(spark, sf_dir, percentile=False).count()


def test_retention(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS t UNION ALL SELECT timestamp_ntz'2023-01-01 00:00:00'")
    kept = gold.retain(df, "t", F.lit("2024-01-05").cast("timestamp_ntz"), gold.RETENTION_DAYS["fraud_analytics_hourly"])
    assert kept.count() == 1
