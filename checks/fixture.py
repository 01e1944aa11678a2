"""Transactions for tests and benchmarks: a deterministic view over the ``events`` table.

The test tables hold no card data. Every event becomes one transaction; components are derived from
its key, with regular gaps, extreme values and exact copies, so that each operator has work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions import timing
from txnlake.operators import gold, ml, silver
from txnlake.schemas import V_COLS
from txnlake.session import ON_RELEASE, configure, work_path
from txnlake.streaming import features

ORIGIN_US = 1704067200000000  # 2024-01-01
AS_OF = "2024-01-31 00:00:00"
RUN_ID = "run-1"


def as_of():
    """Fixed clock of the repeatable queries."""
    return F.lit(AS_OF).cast("timestamp_ntz")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _component(i: int) -> str:
    return (
        f"CASE WHEN event_id % 113 = {i} THEN NULL WHEN event_id % 151 = {i} THEN 12.5D "
        f"ELSE CAST((event_id * {1009 + 37 * i} + {131 * i}) % 1999 AS DOUBLE) / 1999D * 8D - 4D END AS V{i}"
    )


def unique_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, before copies are added; stored in several files, as tables are."""
    return table(spark, sf_dir, "unique")


def _derived(rows: DataFrame, *carried: str) -> DataFrame:
    """Transactions from events; ``carried`` names columns that come along."""
    label = (
        F.when(F.col("event_id") % 499 == 0, None)
        .when((F.col("event_type") == "error") & (F.col("event_id") % 5 == 0), F.lit(1))
        .otherwise(F.lit(0))
    )
    return rows.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("account_id"),
        "ts",
        ((timing.micros(F.col("ts")) - ORIGIN_US).cast("double") / F.lit(1e6)).alias("Time"),
        *[F.expr(_component(i)) for i in range(1, len(V_COLS) + 1)],
        _amount().alias("Amount"),
        label.alias("Class"),
        *carried,
    )


def _amount():
    e, value = F.col("event_id"), F.col("value")
    return (
        F.when(e % 211 == 0, None)
        .when(e % 307 == 0, F.lit(0.0))
        .when(e % 101 == 0, F.round(value * 100.0, 2))
        .when(e % 13 == 0, F.round(value * 10.0, 2))
        .otherwise(value)
    )


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze table: every fiftieth row is there twice."""
    copies = F.when(F.col("id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = unique_txn(spark, sf_dir)
    return rows.withColumn("_copy", F.explode(copies)).drop("_copy")


def silver_table(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    options.setdefault("processed_at", as_of())
    return silver.build(txn(spark, sf_dir), **options)


def hourly_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver_table(spark, sf_dir, percentile=False)
    return gold.build_hourly(rows, RUN_ID, created_at=F.max("ts"))


def current_table(spark: SparkSession, sf_dir: str, percentile: bool = False, rolling: str | None = None) -> DataFrame:
    """The ML feature table. Percentile and rolling columns are added only for queries that read them."""
    rows = silver_table(spark, sf_dir, percentile=percentile, amount_outlier=True)
    return ml.build(rows, rolling=rolling, created_at=F.col("ts"))


def received(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as the stream receives them: lower-case names, nulls kept, event time present."""
    return _as_received(unique_txn(spark, sf_dir))


def _as_received(rows: DataFrame, *carried: str) -> DataFrame:
    return rows.select(
        "id",
        "account_id",
        *[F.col(v).alias(v.lower()) for v in V_COLS],
        F.col("Amount").alias("amount"),
        F.col("Class").alias("class"),
        F.col("ts").alias("created"),
        F.lit(True).alias("created_present"),
        *carried,
    )


def realtime_table(spark: SparkSession, sf_dir: str, stats: bool = False) -> DataFrame:
    """Stream features of all transactions, processed two seconds after the event."""
    return features.feature_record(received(spark, sf_dir), F.expr(PROCESSED), stats=stats)


PROCESSED = "created + INTERVAL 2 SECONDS"


def realtime_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream records with their rolling features and the ``day`` they were processed, dealt and sorted by it.

    The frames and the dealing need the amount and keys only, so rows are shuffled and sorted as events and become records of
    some sixty columns after that.
    """
    rows = events(spark, sf_dir).select(
        "*",
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("account_id"),
        F.col("ts").alias("time_stamp"),
        _amount().alias("amount"),
    )
    own = ["event_id", "user_id", "ts", "event_type", "value"]
    framed = features.with_rolling(features.amount_features(rows).select(*own, "transaction_id", "account_id", "time_stamp", "amount_log"))
    day = F.to_date(F.expr(PROCESSED.replace("created", "ts"))).alias("day")
    carried = [*features.ROLLING_COLS, "day"]
    dealt = framed.select(*own, *features.ROLLING_COLS, day).hint("rebalance", "day").sortWithinPartitions("day", "ts")
    arrived = _as_received(_derived(dealt, *carried), *carried)
    return features.feature_record(arrived, F.expr(PROCESSED), carried=carried)


def stream_raw(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the stream output as JSON text, below one folder per hour."""
    key = (spark.sparkContext.applicationId, sf_dir, "stream_raw")
    if key not in _STORED:
        rows = table(spark, sf_dir, "realtime")
        bucket = timing.hour_bucket(F.col("processed_at"))
        # The table is dealt and sorted by time, so a task meets few hours; it sorts columns, not the longer text.
        placed = rows.withColumn("hour_bucket", bucket).sortWithinPartitions("hour_bucket")
        lines = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("json_data")
        path = work_path(spark, "stream-raw")
        placed.select(lines, "hour_bucket").write.partitionBy("hour_bucket").options(**PACKED).text(path)
        _STORED[key] = (path, None)
    return _STORED[key][0]


# Text is stored packed; such a file is read by one task, so its rows are bounded.
PACKED = {"compression": "gzip", "maxRecordsPerFile": 500_000}

_STORED: dict[tuple[str, str, str], tuple[str, object]] = {}
ON_RELEASE.append(_STORED.clear)


# Time by whose day a table is partitioned.
DAY_OF = {"hourly": "created_at", "current": "created_at", "realtime": "processed_at"}


def table(spark: SparkSession, sf_dir: str, name: str, dated: bool = False) -> DataFrame:
    """A stored gold or stream table, built on first use; ``dated`` keeps its partition column ``day``.

    Analytic queries read tables, not pipelines: ``current`` holds the ML features with all columns
    and its ``split``, ``hourly`` the gold hours, ``realtime`` the stream records.
    """
    build = {
        # The events' file may have a single row group, which one task reads; rows are dealt before they get wide.
        "unique": lambda: _derived(
            events(spark, sf_dir).drop("props").repartition(spark.sparkContext.defaultParallelism)
        ),
        "silver": lambda: silver_table(spark, sf_dir, amount_outlier=True),
        "hourly": lambda: gold.build_hourly(table(spark, sf_dir, "silver"), RUN_ID, created_at=F.max("ts")),
        "current": lambda: ml.build(
            table(spark, sf_dir, "silver"), rolling="account", created_at=F.col("ts"), row_key="id", deal=_by_side_and_day
        ),
        "realtime": lambda: realtime_rolling(spark, sf_dir),
    }[name]
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        df = build()
        path = work_path(spark, f"table-{name}")
        if name in DAY_OF:
            parts = ["split", "day"] if name == "current" else ["day"]
            if "day" not in df.columns:
                df = df.withColumn("day", F.to_date(DAY_OF[name])).hint("rebalance", *parts)
            df.write.partitionBy(*parts).parquet(path)
        else:
            df.write.parquet(path)
        _STORED[key] = (path, df.schema)
    path, schema = _STORED[key]
    rows = spark.read.schema(schema).parquet(path)
    return rows if dated or name not in DAY_OF else rows.drop("day")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The files of a stored table as a stream, with the columns it is partitioned by; nothing is copied."""
    table(spark, sf_dir, name)
    path, schema = _STORED[(spark.sparkContext.applicationId, sf_dir, name)]
    return spark.readStream.schema(schema).parquet(path)


def _by_side_and_day(rows: DataFrame) -> DataFrame:
    return ml.with_split(rows).withColumn("day", F.to_date("ts")).hint("rebalance", "split", "day")


def feature_sets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``current`` and its two sides; a side is one partition of the table."""
    current = table(spark, sf_dir, "current")
    return {"current": current, "train": current.where("split = 'train'"), "test": current.where("split = 'test'")}


def cdc_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction as a CDC message, in the shapes the decoder has to tell apart (by ``id % 12``).

    0 envelope, 1 envelope with an empty image, 2 null payload, 3 no amount, 4 no JSON, 5 amount sent
    as text, 6 key ``v5`` absent, else flat.
    """
    rows = received(spark, sf_dir).withColumns(
        {
            "shape": F.col("id") % 12,
            "parts": F.to_json(F.struct(*features.COMPONENTS), {"ignoreNullFields": "false"}),
            "number": F.coalesce(F.col("amount").cast("string"), F.lit("null")),
        }
    )
    shape = F.col("shape")
    comps = F.expr("substring(parts, 2, length(parts) - 2)")
    shaped = rows.withColumns(
        {
            "comps": F.when(shape == 6, F.regexp_replace(comps, r'"v5":[^,]+,', "")).otherwise(comps),
            "money": F.when(shape == 3, F.lit(""))
            .when((shape == 5) & F.col("amount").isNotNull(), F.format_string(',"amount":"%s"', "number"))
            .otherwise(F.format_string(',"amount":%s', "number")),
            "tail": F.concat(
                F.lit(',"class":'),
                F.coalesce(F.col("class").cast("string"), F.lit("null")),
                F.date_format("created", '\',"created_at":"\'yyyy-MM-dd\'T\'HH:mm:ss.SSSSSS\'"\''),
            ),
        }
    )
    flat = shaped.withColumn(
        "fields", F.format_string('"id":%d,"account_id":%d,%s%s%s', "id", "account_id", "comps", "money", "tail")
    )
    message = (
        F.when(shape == 0, F.format_string('{"payload":{"after":{%s}}}', "fields"))
        .when(shape == 1, F.format_string('{"payload":{"after":{}},"id":%d}', "id"))
        .when(shape == 2, F.format_string('{"payload":null,%s}', "fields"))
        .when(shape == 4, F.format_string("not json %d", "id"))
        .otherwise(F.format_string("{%s}", "fields"))
    )
    return flat.select(F.col("id").alias("message_id"), message.alias("value"))


def change_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of all transactions: an insert each, updates (``id % 10 = 3``), rewritten deletes with
    their tombstones (``id % 17 = 5``)."""
    rows = received(spark, sf_dir)
    i = F.col("id")
    kinds = F.concat(
        F.array(F.lit(0)),
        F.when(i % 10 == 3, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")),
        F.when(i % 17 == 5, F.array(F.lit(2), F.lit(3))).otherwise(F.array().cast("array<int>")),
    )
    spread = rows.withColumn("kind", F.explode(kinds))
    amount = F.when(F.col("kind") == 1, F.coalesce("amount", F.lit(0.0)) + 1.0).otherwise(F.col("amount"))
    image = F.struct(
        "id",
        amount.alias("amount"),
        "class",
        F.when(F.col("kind") == 2, "true").otherwise("false").alias("__deleted"),
        F.lit("fraud_transactions").alias("__table"),
        (i * 10 + F.col("kind")).alias("__lsn"),
        F.expr("unix_millis(CAST(created AS TIMESTAMP))").alias("__source_ts_ms"),
    )
    value = F.when(F.col("kind") < 3, F.to_json(image, {"ignoreNullFields": "false"}))
    return spread.select(value.alias("value"))
