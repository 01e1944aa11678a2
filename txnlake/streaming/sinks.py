"""Stream writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from txnlake.functions.timing import hour_bucket
from txnlake.operators import cdc
from txnlake.session import work_path
from txnlake.streaming.runs import RunLog

CHECKPOINT_PERIOD = "60 seconds"


def trigger(writer: DataStreamWriter, once: bool) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=CHECKPOINT_PERIOD)


def json_files(
    records: DataFrame,
    path: str,
    checkpoint: str,
    bucket_by: str = "processed_at",
    once: bool = False,
    writers: int | None = None,
):
    """Append JSON lines below one folder per hour; a checkpoint every 60 seconds.

    ``writers`` bounds the files of one micro-batch and hour: an hour's rows are dealt to so many places by their hash,
    and all places to the tasks of a shuffle, whose number follows the data.
    """
    bucketed = records.withColumn("hour_bucket", hour_bucket(F.col(bucket_by)))
    if writers:
        bucketed = bucketed.repartition("hour_bucket", _place(records, writers))
    writer = (
        bucketed.writeStream.format("json")
        .option("path", path)
        .option("ignoreNullFields", "false")
        .option("checkpointLocation", checkpoint)
        .partitionBy("hour_bucket")
        .outputMode("append")
    )
    return trigger(writer, once).start()


def _place(rows: DataFrame, places: int) -> Column:
    """A place from 0 for each row, the same in every run; columns that have no hash (maps) take no part."""
    hashed = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashed]), F.lit(places))


def table_files(rows: DataFrame, path: str, checkpoint: str, once: bool = False, fmt: str = "parquet"):
    """Append rows to plain files (alerts, closed windows, quarantined records)."""
    writer = (
        rows.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    )
    return trigger(writer, once).start()


def image_log(spark: SparkSession, path: str, schema: str, **sizes) -> RunLog:
    return RunLog(spark, path, "id", schema, cdc.latest_images, **sizes)


def append_images(changes: DataFrame, path: str, checkpoint: str, once: bool = False, **sizes):
    """Keep the folded change images of every micro-batch as a run of a log (:mod:`txnlake.streaming.runs`).

    Runs of like size are folded, so the folders a reader opens grow with the logarithm of the log; one manifest
    switches to each new state as a whole. A repeated batch replaces its own run, so a restart is safe. Deletes stay as
    images, so that an older image that comes later does not bring its key back.
    """
    schema = changes.schema.toDDL()

    def write(batch: DataFrame, number: int) -> None:
        log, at = image_log(batch.sparkSession, path, schema, **sizes), (number, 0)
        log.sweep(at)
        runs = log.manifest(at)["runs"]
        made = log.add(batch.where(F.col("id").isNotNull()), f"batch-{number:012d}")
        log.commit(at, log.folded(runs + ([made] if made["rows"] else []), at), {"schema": schema})

    writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return trigger(writer, once).start()


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """Latest image per key that is not a delete, as of the newest manifest."""
    found = image_log(spark, path, "").manifest()
    if "schema" not in found["more"]:
        raise FileNotFoundError(f"no change images below {path}")
    return cdc.live_rows(image_log(spark, path, found["more"]["schema"]).read(found["runs"]))


def run_to_end(rows: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Run a stream over everything available and read back what it wrote."""
    spark = rows.sparkSession
    out, checkpoint = work_path(spark, name), work_path(spark, f"{name}-checkpoint")
    query = table_files(rows, out, checkpoint, once=True, fmt=fmt)
    query.awaitTermination()
    return spark.read.schema(rows.schema).format(fmt).load(out)
