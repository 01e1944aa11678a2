"""The whole lake: bronze file to silver, silver to gold, change stream to JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.timing import hour_bucket, seconds_to_ntz
from txnlake.operators import gold, ml, profile, quality, silver
from txnlake.schemas import CORRUPT, REQUIRED_BRONZE
from txnlake.session import materialize, scratch
from txnlake.sources import files
from txnlake.streaming import decode, features, rolling, sinks

HOURLY, FEATURES, RISK, SUMMARY = "fraud_analytics_hourly", "ml_features", "risk_profiles", "summary_stats"


def with_keys(bronze: DataFrame) -> DataFrame:
    """Add the key, account and time a raw card file lacks.

    The key is a hash of the row: exact copies share it, and it does not depend on how the file is
    split. Without accounts the rolling features run over the whole table.
    """
    return bronze.select(
        F.xxhash64(*bronze.columns).alias("id"),
        F.lit(None).cast("long").alias("account_id"),
        seconds_to_ntz(F.col("Time")).alias("ts"),
        *bronze.columns,
    )


def land_bronze(spark: SparkSession, csv_path: str, lake: str, version: str) -> DataFrame:
    """Typed bronze rows with keys; the lines that could not be read are the partition ``malformed=true``."""
    raw = files.read_csv(spark, csv_path)
    path = f"{lake}/bronze/{version}"
    raw.withColumn("malformed", F.col(CORRUPT).isNotNull()).write.mode("overwrite").partitionBy("malformed").parquet(path)
    return with_keys(spark.read.parquet(path).where("NOT malformed").drop("malformed", CORRUPT))


def bronze_to_silver(spark: SparkSession, csv_path: str, lake: str, version: str) -> dict[str, str]:
    """Validate, clean and write silver (a versioned copy, named as the current one) and its run report.

    The text is parsed once: typed rows land as Parquet, malformed lines beside them.
    """
    bronze = land_bronze(spark, csv_path, lake, version)
    quality.require_columns(bronze, REQUIRED_BRONZE)
    clean = silver.cleaned(bronze)
    table = silver.build(bronze, amount_outlier=True, clean=clean)
    versioned, current = files.write_versioned(table, f"{lake}/silver", version)
    checks = quality.evaluate(bronze, quality.bronze_rules())
    metrics = silver.stored_metrics(bronze, bronze, clean, spark.read.parquet(versioned))
    report = silver.lineage_report(checks, metrics, csv_path, versioned)
    expected = [quality.expect_in_set(bronze), quality.expect_between(bronze)]
    report = report.unionByName(profile.gold_report({"expectations": expected[0].unionByName(expected[1])}))
    files.write_gold(report, f"{lake}/reports/silver-{version}")
    return {"versioned": versioned, "current": current, "report": f"{lake}/reports/silver-{version}"}


def retained(rows: DataFrame, name: str, as_of: Column | None, ts: str = "created_at") -> DataFrame:
    """Rows that the retention period of a gold table keeps at ``as_of`` (none: all)."""
    return rows if as_of is None else gold.retain(rows, ts, as_of, gold.RETENTION_DAYS[name])


def silver_to_gold(spark: SparkSession, lake: str, version: str, rolling_by: str = "global", as_of: Column | None = None) -> dict[str, str]:
    """Build the gold tables from the newest silver snapshot and write them with a report.

    With ``as_of`` rows older than the retention period of their table are left out; profiles and statistics, which are
    made anew each time and have no time, describe the transactions of their period.

    The feature table is written once, partitioned by ``split`` and day: train and test are its partitions.
    """
    source = files.latest_snapshot(spark, f"{lake}/silver")
    rows = spark.read.parquet(source)
    paths = {n: f"{lake}/gold/{n}" for n in (HOURLY, FEATURES, RISK, SUMMARY)}
    checked = quality.report(quality.evaluate(rows, quality.silver_rules()))
    files.write_gold(profile.gold_report({"silver_rules": checked}), f"{lake}/reports/silver-rules-{version}")
    hours = gold.with_amount_categories(gold.build_hourly(rows, version), rows)
    features_table = ml.with_split(ml.build(rows, rolling=rolling_by))
    day = F.to_date("created_at")
    files.write_gold(retained(hours.withColumn("day", day), HOURLY, as_of), paths[HOURLY], ["day"], whole=True)
    files.write_gold(retained(features_table.withColumn("day", day), FEATURES, as_of), paths[FEATURES], ["split", "day"], whole=True)
    files.write_gold(gold.risk_profiles(retained(rows, RISK, as_of, "ts")), paths[RISK])
    files.write_gold(gold.summary_stats(retained(rows, SUMMARY, as_of, "ts")), paths[SUMMARY])
    files.write_gold(gold_report(spark, lake), f"{lake}/reports/gold-{version}")
    return paths


def gold_report(spark: SparkSession, lake: str) -> DataFrame:
    """Profiles of every gold table and the file inventory as one long table."""
    hours = spark.read.parquet(f"{lake}/gold/{HOURLY}")
    features_table = spark.read.parquet(f"{lake}/gold/{FEATURES}")
    return profile.gold_report(
        {
            "hourly": profile.hourly(hours.drop("day")),
            "ml_features": profile.ml({"current": features_table.drop("split", "day")}),
            "risk_profiles": profile.risk(spark.read.parquet(f"{lake}/gold/{RISK}")),
            "summary_stats": profile.summary(spark.read.parquet(f"{lake}/gold/{SUMMARY}")),
            "inventory": files.inventory(spark, f"{lake}/gold"),
        }
    )


def stream_job(messages: DataFrame, lake: str, once: bool = False, delay: str | None = rolling.DELAY) -> list:
    """Decode, derive, roll and write a change stream; alerts and undecodable records get own folders.

    A micro-batch is decoded once for all three outputs; each goes to a folder of its batch, so that
    a repeated micro-batch replaces what it wrote. Rewritten deletes are no transactions. Records wait ``delay`` for
    late ones; with ``once`` the call returns when everything available is written, those that wait included.
    """
    root = f"{lake}/stream"

    def put(rolled: DataFrame, number: int) -> None:
        hours = rolled.withColumn("hour_bucket", hour_bucket(F.col("processed_at")))
        hours.write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("hour_bucket").json(f"{root}/records/batch={number}")

    def record_of(valid: DataFrame) -> DataFrame:
        return features.feature_record(decode.typed(decode.live(valid)), F.current_timestamp())

    def write(batch: DataFrame, number: int) -> None:
        with scratch(batch.sparkSession):
            valid, rejected = decode.parted(materialize(decode.with_image(batch), "images"))
            record = materialize(record_of(valid), "records")
            rolling.roll(record, number, f"{root}/state", lambda rolled: put(rolled, number), delay)
            features.alerts(record).write.mode("overwrite").parquet(f"{root}/alerts/batch={number}")
            rejected.write.mode("overwrite").parquet(f"{root}/quarantine/batch={number}")

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", f"{lake}/checkpoints/stream")
    query = sinks.trigger(writer, once).start()
    if once:
        query.awaitTermination()
        schema = record_of(decode.split_valid(messages)[0]).schema
        rolling.flush(messages.sparkSession.createDataFrame([], schema), f"{root}/state", put)
    return [query]
