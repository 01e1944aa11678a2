"""The lake end to end, from a raw file and from a change stream."""

import os

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from txnlake.__main__ import result
from txnlake.operators import gold, silver
from txnlake.plans import pipeline
from txnlake.schemas import BRONZE_COLS
from txnlake.session import shared_dir
from txnlake.sources import files, tables


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    raw = fx.txn(spark, sf_dir).select(*BRONZE_COLS)
    files.write_csv(raw, str(root / "raw"))
    shown = result(spark, ["run", str(root / "raw"), str(root), "v1"])
    assert shown.count() > 0
    return str(root)


def test_silver_and_features(spark, sf_dir, lake):
    current = spark.read.parquet(files.current_snapshot(spark, f"{lake}/silver"))
    distinct = fx.txn(spark, sf_dir).select(*BRONZE_COLS).distinct().where("Class IS NOT NULL").count()
    assert current.count() == distinct == spark.read.parquet(f"{lake}/silver/creditcard_sample_v1").count()
    features = spark.read.parquet(f"{lake}/gold/{pipeline.FEATURES}")
    assert features.count() == distinct
    assert {r["split"] for r in features.select("split").distinct().collect()} == {"train", "test"}
    assert features.where("Amount_Rolling_Mean IS NULL").count() == 0


def test_hours_add_up(spark, lake):
    total = spark.read.parquet(f"{lake}/gold/{pipeline.HOURLY}").agg(F.sum("total_transactions")).first()[0]
    assert total == spark.read.parquet(files.current_snapshot(spark, f"{lake}/silver")).count()


def test_commands(spark, lake):
    assert {r["dataset"] for r in result(spark, ["list", lake]).collect()} == {
        pipeline.HOURLY, pipeline.FEATURES, pipeline.RISK, pipeline.SUMMARY,
    }
    for kind in ("fraud", "ml", "risk", "summary"):
        assert result(spark, ["validate", kind, lake]).count() > 0
    assert result(spark, ["analyze", f"{lake}/gold/{pipeline.HOURLY}"]).count() == 15
    assert result(spark, ["report", lake]).select("section").distinct().count() == 5
    assert result(spark, ["validate", "nothing", lake]) is None


def test_tables_views_and_queries_by_name(spark, lake, sf_dir):
    names = {r["name"] for r in result(spark, ["register", lake]).collect()}
    assert f"gold_ml.{pipeline.FEATURES}" in names and "fraud_detection_summary" in names
    total = spark.sql(f"SELECT count(*) FROM gold_ml.{pipeline.FEATURES}").first()[0]
    assert total == spark.read.parquet(files.current_snapshot(spark, f"{lake}/silver")).count()
    assert spark.sql("SELECT max(total_transactions) FROM fraud_detection_summary").first()[0] == total
    for name in ("amount_ranges", "dataset_compare", "fraud_summary", "dataset_counts", "fraud_samples", "class_counts", "overall_fraud_rate"):
        assert result(spark, ["query", name, lake]).count() > 0
    assert result(spark, ["query", "nothing", lake]) is None
    assert result(spark, ["silver", lake]).where("section = 'rules'").count() > 0


def test_retention_of_a_lake(spark, lake):
    """Every gold table goes by its own period."""
    assert gold.RETENTION_DAYS == {pipeline.HOURLY: 90, pipeline.FEATURES: 365, pipeline.RISK: 730, pipeline.SUMMARY: 730}
    rows = spark.read.parquet(files.current_snapshot(spark, f"{lake}/silver"))
    newest = rows.agg(F.max("ts")).first()[0]
    for name, days in gold.RETENTION_DAYS.items():
        for more, some in ((-1, True), (1, False)):
            as_of = F.lit(newest).cast("timestamp_ntz") + F.expr(f"INTERVAL {days + more} DAYS")
            assert pipeline.retained(rows, name, as_of, "ts").isEmpty() != some
    assert pipeline.retained(rows, pipeline.RISK, None, "ts").count() == rows.count()


def test_report_names_steps(spark, lake):
    report = spark.read.parquet(f"{lake}/reports/silver-v1")
    steps = {r["value"] for r in report.where("item LIKE 'step_%'").collect()}
    assert steps == set(silver.STEPS)


def test_stored_metrics_equal_the_direct_ones(spark, sf_dir):
    bronze = fx.txn(spark, sf_dir)
    clean = silver.cleaned(bronze)
    table = silver.build(bronze, percentile=False, clean=clean)
    assert silver.stored_metrics(bronze, bronze, clean, table).first() == silver.run_metrics(bronze).first()


def test_profiles_checks_and_categories_of_a_raw_file(spark, lake):
    profiles = spark.read.parquet(f"{lake}/gold/{pipeline.RISK}")
    silver_rows = spark.read.parquet(files.current_snapshot(spark, f"{lake}/silver")).count()
    assert profiles.count() > 0 and profiles.where("account_id IS NOT NULL").count() == 0
    assert profiles.agg(F.sum("total_transactions")).first()[0] == silver_rows
    assert {r["customer_segment"] for r in profiles.collect()} <= {"Low", "Medium", "High", "Very_High"}
    hours = spark.read.parquet(f"{lake}/gold/{pipeline.HOURLY}")
    counted = hours.select("total_transactions", F.aggregate(F.map_values("amount_category_dist"), F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    assert counted.where("n < total_transactions").count() == 0
    assert spark.read.parquet(f"{lake}/reports/silver-rules-v1").where("item LIKE '%status'").count() == 1
    assert spark.read.parquet(f"{lake}/reports/silver-v1").where("section = 'expectations'").count() > 0


def test_sample_is_a_share_of_keys(spark, sf_dir):
    rows = fx.txn(spark, sf_dir)
    taken = silver.sample(rows, 0.3)
    keys = {r["id"] for r in taken.select("id").collect()}
    assert 0.2 < len(keys) / rows.select("id").distinct().count() < 0.4
    assert taken.count() == rows.where(F.col("id").isin(sorted(keys))).count()
    m = silver.run_metrics(rows, taken).first()
    assert (m["processing_mode"], m["sample_size"]) == ("SAMPLE", taken.count())


def test_stream_job(spark, sf_dir, tmp_path):
    deleted = spark.createDataFrame([('{"id": 1, "amount": 2.0, "__deleted": "true"}',)], "value string")
    messages = fx.cdc_messages(spark, sf_dir).select("value").unionByName(deleted)
    messages.write.text(str(tmp_path / "in"))
    for query in pipeline.stream_job(tables.read_text_stream(spark, str(tmp_path / "in")), str(tmp_path), once=True):
        query.awaitTermination()
    written = files.read_json_text(spark, f"{tmp_path}/stream/records").count()
    rejected = spark.read.parquet(f"{tmp_path}/stream/quarantine").count()
    assert written + rejected == messages.count() - 1
    assert rejected == fx.unique_txn(spark, sf_dir).where("id % 12 IN (1, 2, 3, 4)").count()


def test_stream_job_leaves_nothing_behind(spark, sf_dir, tmp_path):
    """After many micro-batches the work folder holds what it held, and the state no more folders than after a few."""
    messages = fx.cdc_messages(spark, sf_dir).select("value").where("value LIKE '{\"id\"%'").limit(40).repartition(5)
    shared = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    before = sorted(os.listdir(shared))
    messages.write.text(str(tmp_path / "in"))
    stream = tables.read_text_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    pipeline.stream_job(stream, str(tmp_path), once=True)
    assert sorted(os.listdir(shared)) == before
    assert len([n for n in os.listdir(f"{tmp_path}/stream/state/manifests") if n.endswith(".json")]) <= 4
    rejected = spark.read.parquet(f"{tmp_path}/stream/quarantine").count()
    assert files.read_json_text(spark, f"{tmp_path}/stream/records").count() + rejected == 40
    assert len(os.listdir(f"{tmp_path}/stream/state/runs")) <= 5 + 1 and len(os.listdir(f"{tmp_path}/stream/alerts")) >= 5
