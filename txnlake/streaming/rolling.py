"""Rolling state of the last 100 records per account, in Spark's own operators.

The state is a log of runs (:mod:`txnlake.streaming.runs`): a micro-batch appends the last 99 of its own records per
account and reads the kept ones of the accounts it touches; the frames are computed as in the batch form (which splits
busy accounts).

Records newer than the horizon, the newest event time less ``delay``, wait, so that late ones still fall into their
place. They are written once, partitioned by time, and read once, when the horizon has passed them. A record later
than the delay takes its place among the last 99 kept of its account. A run over everything available ends with a flush:
what waits then is taken as complete.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnlake.functions.timing import micros
from txnlake.operators import scale
from txnlake.session import materialize, scratch
from txnlake.streaming.features import ROLLING_COLS, ROLLING_ROWS, with_rolling
from txnlake.streaming.runs import RUN, RunLog, bucket_of, read_folders
from txnlake.streaming.sinks import trigger

KEPT = ["account_id", "transaction_id", "time_stamp", "amount_log"]
# How long a record waits for late ones before it takes its place; None: not at all.
DELAY = "10 minutes"
# Waiting records are partitioned by time in so many slots per delay.
SLOTS = 8
Write = Callable[[DataFrame], None]


def last_records(rows: DataFrame, size: int = ROLLING_ROWS) -> DataFrame:
    """The last ``size - 1`` records per account; all but these leave before the shuffle."""
    newest = Window.partitionBy("account_id").orderBy(F.desc("time_stamp"), F.desc("transaction_id"))
    return rows.select(*KEPT).withColumn("_place", F.row_number().over(newest)).where(F.col("_place") < size).drop("_place")


def state_log(records: DataFrame, state: str) -> RunLog:
    return RunLog(records.sparkSession, state, "account_id", records.select(*KEPT).schema.toDDL(), last_records)


def _wait(batch: DataFrame, begun: dict, log: RunLog, at: tuple[int, int], delay: str | None, final: bool) -> tuple[DataFrame, dict]:
    """The records whose time has come, and what the manifest has to say of those that wait."""
    spark, us = log.spark, micros(F.col("time_stamp"))
    seen = batch.agg(F.max(us)).first()[0]
    before = begun.get("horizon")
    newest = max((x for x in (seen, begun.get("newest")) if x is not None), default=None)
    if newest is None:
        return batch, begun
    if delay is None or final:
        width, horizon = 0, newest + 1
    else:
        width = spark.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {delay})").first()[0]
        horizon = newest - width
    horizon = horizon if before is None else max(before, horizon)
    waiting = [w for w in begun.get("waiting", []) if before is None or w["last"] >= before]
    ready = batch.where(us.isNull() | (us < horizon))
    if due := [w for w in waiting if w["first"] < horizon]:
        held = read_folders(spark, f"{batch.schema.toDDL()}, _slot LONG", f"{log.path}/waiting", [w["name"] for w in due])
        # Slots are whole folders; the times inside them decide.
        held = held.where((F.col("_slot") < horizon) & (us < horizon) & (us >= before)).drop("_slot")
        ready = ready.unionByName(held)
    if width and seen is not None and seen >= horizon:
        name, slot = f"batch-{at[0]:012d}-{at[1]}", max(1, width // SLOTS)
        later = batch.where(us >= horizon).withColumn("_slot", us - F.pmod(us, F.lit(slot)))
        later.write.mode("overwrite").partitionBy("_slot").parquet(f"{log.path}/waiting/{RUN}={name}")
        waiting = [*waiting, {"name": name, "first": horizon, "last": seen}]
    left = [w for w in waiting if w["last"] >= horizon]
    return ready, {"newest": newest, "horizon": horizon, "waiting": left}


def roll(batch: DataFrame, number: int, state: str, write: Write, delay: str | None = DELAY, final: bool = False, **limits) -> None:
    """Give ``write`` the records of one micro-batch (and those that waited) with their rolling columns; keep the new state.

    ``final`` takes what waits as complete. A repeated call begins from the same state and replaces what it wrote.
    """
    log, at = state_log(batch, state), (number, int(final))
    log.sweep(at)
    begun = log.manifest(at)
    ready, more = _wait(batch, begun["more"], log, at, delay, final)
    sizes = {r[0]: r["count"] for r in ready.groupBy(bucket_of("account_id", log.buckets).alias("b")).count().collect()}
    accounts = ready.select(F.col("account_id").alias("_touched")).distinct()
    kept = log.read(begun["runs"], list(sizes))
    kept = last_records(kept.join(accounts, F.col("account_id").eqNullSafe(F.col("_touched")), "left_semi"))
    # Records travel as one column beside those that the frames need.
    new = ready.select(*KEPT, F.struct(*ready.columns).alias("_record"))
    if max(sizes.values(), default=0) + ROLLING_ROWS <= limits.get("hot_rows", scale.HOT_ROWS):
        limits = {**limits, "hot_rows": None}  # no account has more rows than its bucket
    rolled = with_rolling(new.unionByName(kept, allowMissingColumns=True), **limits)
    write(rolled.where("_record IS NOT NULL").select("_record.*", *ROLLING_COLS))
    tail = log.add(ready, f"tail-{number:012d}-{at[1]}")
    log.commit(at, log.folded(begun["runs"] + ([tail] if tail["rows"] else []), at), more)


def flush(records: DataFrame, state: str, write: Callable[[DataFrame, int], None], **limits) -> None:
    """Give ``write`` what still waits after the last micro-batch, and the negative number of its folder."""
    log = state_log(records, state)
    last = log.last()
    if last and log.manifest()["more"].get("waiting"):
        nothing = records.sparkSession.createDataFrame([], records.schema)
        with scratch(records.sparkSession):
            roll(nothing, last[0], state, lambda rolled: write(rolled, -1 - last[0]), final=True, **limits)


def rolling_files(records: DataFrame, path: str, state: str, checkpoint: str, delay: str | None = DELAY, once: bool = False) -> StreamingQuery:
    """Write a stream of feature records with rolling columns below ``<path>/batch=<n>`` (below zero: flushes).

    With ``once`` the call returns when everything available is written and flushed.
    """

    def put(rolled: DataFrame, number: int) -> None:
        rolled.write.mode("overwrite").parquet(f"{path}/batch={number}")

    def write(batch: DataFrame, number: int) -> None:
        with scratch(batch.sparkSession):
            roll(materialize(batch, "batch"), number, state, lambda rolled: put(rolled, number), delay)

    query = trigger(records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), once).start()
    if once:
        query.awaitTermination()
        flush(records, state, put)
    return query


def read_rolled(spark: SparkSession, schema: str, path: str) -> DataFrame:
    """What :func:`rolling_files` wrote of records of a schema."""
    return spark.read.schema(", ".join([schema, *[f"{c} DOUBLE" for c in ROLLING_COLS]])).parquet(path)
