"""Decoding, stateful features, windows, sinks and restarts."""

import datetime as dt
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from txnlake.sources import files, tables
from txnlake.streaming import decode, features, sinks, windows
from txnlake.streaming import rolling as rolling_state


def flat(i, **more):
    out = {"id": i, "amount": 10.5, "class": 0, "created_at": "2024-01-06 18:30:00"}
    out.update({f"v{k}": 0.2 for k in range(1, 29)})
    out.update(more)
    return {k: v for k, v in out.items() if v != "absent"}


CASES = {
    "flat": json.dumps(flat(1)),
    "envelope": json.dumps({"payload": {"after": flat(2)}}),
    "delete": json.dumps({"payload": {"after": None}}),
    "empty after, flat": json.dumps({"payload": {"after": {}}, **flat(3)}),
    "after is a number": json.dumps({"payload": {"after": 5}, **flat(4)}),
    "null payload": json.dumps({"payload": None, **flat(5)}),
    "text payload": json.dumps({"payload": "x", **flat(6)}),
    "payload without after, flat": json.dumps({"payload": {"op": "c"}, **flat(7)}),
    "no amount": json.dumps(flat(8, amount="absent")),
    "no id": '{"amount": 4}',
    "null amount": json.dumps(flat(9, amount=None)),
    "not json": "oops",
    "truncated": '{"id": 1, "amount": 2',
    "array": "[1, 2]",
    "empty": "",
    "null": None,
    "absent v5": json.dumps(flat(10, v5="absent")),
    "null v5": json.dumps(flat(11, v5=None)),
    "text numbers": json.dumps(flat(12, amount="12.5", v1="-4.5")),
    "bad text number": json.dumps(flat(13, v1="abc")),
    "no time": json.dumps(flat(14, created_at="absent")),
    "null time": json.dumps(flat(15, created_at=None)),
    "bad time": json.dumps(flat(16, created_at="garbage")),
    "epoch": json.dumps(flat(17, created_at=1704565800)),
    "epoch as text": json.dumps(flat(18, created_at="1704565800")),
    "offset": json.dumps(flat(19, created_at="2024-01-06T18:30:00+07:00")),
    "no class": json.dumps(flat(20, **{"class": "absent"})),
}
REJECTED = {
    "delete", "after is a number", "null payload", "text payload", "no amount", "no id", "not json", "truncated", "array",
    "empty", "null",
}


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame(list(CASES.items()), "case string, value string")


@pytest.fixture(scope="module")
def decoded(messages):
    valid, _ = decode.split_valid(messages)
    return {r["case"]: r for r in decode.typed(valid).collect()}


def test_rejected_records(messages):
    valid, rejected = decode.split_valid(messages)
    assert {r["case"] for r in rejected.select("case").collect()} == REJECTED
    assert {r["case"] for r in valid.select("case").collect()} == set(CASES) - REJECTED


def test_values(decoded):
    assert (decoded["flat"]["id"], decoded["flat"]["amount"], decoded["flat"]["v28"]) == (1, 10.5, 0.2)
    assert decoded["envelope"]["id"] == 2 and decoded["empty after, flat"]["id"] == 3
    assert decoded["payload without after, flat"]["id"] == 7
    assert decoded["null amount"]["amount"] is None
    assert decoded["absent v5"]["v5"] == 0.0 and decoded["null v5"]["v5"] is None
    assert (decoded["text numbers"]["amount"], decoded["text numbers"]["v1"]) == (12.5, -4.5)
    assert decoded["bad text number"]["v1"] is None
    assert decoded["no class"]["class"] == 0


def test_times(decoded):
    when = dt.datetime(2024, 1, 6, 18, 30)
    assert decoded["flat"]["created"] == decoded["offset"]["created"] == decoded["epoch"]["created"] == when
    assert not decoded["no time"]["created_present"] and not decoded["null time"]["created_present"]
    for case in ("bad time", "epoch as text"):
        assert decoded[case]["created_present"] and decoded[case]["created"] is None


def test_features_of_decoded_records(messages):
    valid, _ = decode.split_valid(messages)
    out = features.feature_record(decode.typed(valid).drop("case"), F.lit("2024-01-07").cast("timestamp_ntz"))
    got = {r["transaction_id"]: r for r in out.collect()}
    assert got[1]["hour"] == 18 and got[1]["is_weekend"] == 1 and got[1]["time_cluster"] == 2
    assert got[10]["data_quality_score"] == 1.0
    assert got[11]["data_quality_score"] == pytest.approx(1 - 0.3 / 28)
    assert got[9]["data_quality_score"] == pytest.approx(0.7) and got[9]["amount"] == 0.0
    assert (got[14]["hour"], got[14]["hour_cos"], got[14]["time_cluster"]) == (0, 0.0, 0)
    assert (got[16]["hour"], got[16]["day_of_week"], got[16]["hour_cos"], got[16]["time_cluster"]) == (12, 1, 1.0, 1)
    assert got[14]["risk_score"] == pytest.approx(0.2) and got[16]["risk_score"] == 0.0
    assert got[1]["pca_skewness"] == 0.0 and got[1]["pca_kurtosis"] == 0.0


def test_json_out_keeps_nulls(spark):
    line = features.json_lines(spark.sql("SELECT 1 AS a, CAST(NULL AS INT) AS b")).first()[0]
    assert json.loads(line) == {"a": 1, "b": None}


@pytest.fixture(scope="module")
def records(spark, sf_dir):
    return fx.realtime_table(spark, sf_dir).orderBy("time_stamp", "transaction_id").cache()


def halves(records):
    """The records in event order, in two parts."""
    middle = records.selectExpr("percentile(unix_micros(CAST(time_stamp AS TIMESTAMP)), 0.5)").first()[0]
    us = F.expr("unix_micros(CAST(time_stamp AS TIMESTAMP))")
    return records.where(us <= middle).coalesce(1), records.where(us > middle).coalesce(1)


def rolled(spark, records, parts, tmp_path, delay=None, runs=1):
    """The parts as micro-batches of one stream, in so many runs of it."""
    folder, out, state, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state", "cp"))
    for i, part in enumerate(parts, 1):
        part.coalesce(1).write.mode("append").parquet(folder)
        if i * runs % len(parts) == 0:
            stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 1).parquet(folder)
            rolling_state.rolling_files(stream, out, state, checkpoint, delay, once=True)
    return rolling_state.read_rolled(spark, records.schema.toDDL(), out)


def assert_rolled(got, want):
    cols = ["transaction_id", *features.ROLLING_COLS]
    got = {r[0]: r[1:] for r in got.select(*cols).collect()}
    want = {r[0]: r[1:] for r in want.select(*cols).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9)


def test_rolling_stream_restarts_from_its_checkpoint(spark, records, tmp_path):
    assert_rolled(rolled(spark, records, halves(records), tmp_path, delay="10 minutes", runs=2), features.with_rolling(records))


@pytest.mark.parametrize("delay", [True, False])
def test_rolling_stream_of_a_busy_account_with_late_rows(spark, records, tmp_path, delay):
    """One account has a third of the rows; every tenth row comes a batch late. Waiting makes the result that of a batch."""
    busy = records.withColumn("account_id", F.when(F.col("transaction_id") % 3 == 0, 7).otherwise(F.col("account_id")))
    span = busy.selectExpr("min(time_stamp) AS a", "max(time_stamp) AS b").first()
    third = (span["b"] - span["a"]) / 3
    part = F.when(F.col("time_stamp") < F.lit(span["a"] + third), 0).when(F.col("time_stamp") < F.lit(span["a"] + 2 * third), 1).otherwise(2)
    dealt = busy.withColumn("part", part + (F.col("transaction_id") % 10 == 4).cast("int")).cache()
    parts = [dealt.where(F.col("part") == i).drop("part") for i in range(4)]
    hours = int(third.total_seconds() // 3600) + 1
    got = rolled(spark, busy, parts, tmp_path, delay=f"{hours} HOURS" if delay else None)
    want = features.with_rolling(busy)
    if delay:
        assert_rolled(got, want)
    else:
        cols = ["transaction_id", *features.ROLLING_COLS]
        assert got.count() == want.count() and got.select(cols).exceptAll(want.select(cols)).count() > 0


def kept(df):
    rows = []
    return rows, lambda rolled: rows.extend(rolled.collect())


def test_rolling_stream_keeps_all_columns_and_repeats_safely(spark, records, tmp_path):
    some, state = records.orderBy("transaction_id").limit(50).cache(), str(tmp_path / "state")
    early, late = some.where("transaction_id % 2 = 0"), some.where("transaction_id % 2 = 1")
    for number, batch in enumerate((early, late)):
        results = []
        for _ in range(2):
            rows, write = kept(batch)
            rolling_state.roll(batch, number, state, write, delay=None)
            results.append(sorted(rows, key=lambda r: r["transaction_id"]))
        assert results[0] == results[1] and len(results[0]) == batch.count()
        schema = features.with_rolling(some).schema
        back = spark.createDataFrame(results[0], schema).select(*records.columns)
        assert back.exceptAll(batch).count() == 0 and batch.exceptAll(back).count() == 0


def test_waiting_records_of_a_repeated_batch_and_a_flush(spark, tmp_path):
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    schema = "account_id long, transaction_id long, time_stamp timestamp_ntz, amount_log double"
    batches = [[(1, 1, at(0), 1.0), (1, 2, at(9), 2.0)], [(1, 3, at(5), 3.0), (None, 4, at(12), 4.0)], [(1, 5, None, 5.0)], [(1, 6, at(60), 6.0), (1, 7, at(2), 7.0)]]
    state, out = str(tmp_path), {}
    for number, rows in enumerate(batches):
        for _ in range(2):
            got, write = kept(None)
            rolling_state.roll(spark.createDataFrame(rows, schema), number, state, write, delay="10 minutes")
            out[number] = {r["transaction_id"]: r["rolling_mean_100"] if "rolling_mean_100" in r else r[4] for r in got}
    assert {n: sorted(r) for n, r in out.items()} == {0: [], 1: [1], 2: [5], 3: [2, 3, 4, 7]}
    flushed = {}
    rolling_state.flush(spark.createDataFrame([], schema), state, lambda rolled, number: flushed.setdefault(number, rolled.collect()))
    assert [r["transaction_id"] for r in flushed[-4]] == [6]
    again = {}
    rolling_state.flush(spark.createDataFrame([], schema), state, lambda rolled, number: again.setdefault(number, 1))
    assert again == {}


def bytes_below(folder):
    return sum(p.stat().st_size for p in pathlib.Path(folder).rglob("*.parquet"))


def test_a_batch_writes_what_it_touches(spark, tmp_path):
    """The state holds 60,000 accounts; batches of five write a small part of it, also when runs are folded."""
    base, state = dt.datetime(2024, 1, 1), str(tmp_path)
    record = "account_id long, transaction_id long, time_stamp timestamp_ntz, amount_log double"
    many = spark.range(60_000).selectExpr("id AS account_id", "id AS transaction_id", "timestamp_ntz'2023-12-31' AS time_stamp", "rand(1) AS amount_log")
    rolling_state.roll(many, 0, state, lambda rolled: rolled.count(), delay=None)
    first = bytes_below(f"{state}/runs")
    for number in range(1, 10):
        rows = [(i, number * 10 + i, base + dt.timedelta(minutes=number), 1.0) for i in range(5)]
        rolling_state.roll(spark.createDataFrame(rows, record), number, state, lambda rolled: rolled.count(), delay=None)
    log = rolling_state.state_log(many, state)
    live = log.manifest()["runs"]
    assert [r["rows"] for r in live if r["name"].startswith("tail-000000000000")] == [60_000]
    assert len(live) == 3 and any(r["name"].startswith("fold") and r["rows"] == 40 for r in live)
    assert bytes_below(f"{state}/runs") - first < first / 3
    assert log.current().where("account_id = 3").count() == 10


def test_velocity_stream_equals_batch_for_closed_windows(spark, records, tmp_path):
    narrow = records.select("account_id", "time_stamp")
    narrow.write.parquet(str(tmp_path / "in"))
    stream = windows.velocity(spark.readStream.schema(narrow.schema).parquet(str(tmp_path / "in")), late="10 minutes")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    sinks.table_files(stream, out, checkpoint, once=True).awaitTermination()
    got = spark.read.schema(stream.schema).parquet(out)
    want = windows.velocity(narrow)
    newest = narrow.agg(F.max("time_stamp")).first()[0]
    closed = want.where(F.col("window_start") + F.expr("INTERVAL 5 MINUTES") <= F.lit(newest - dt.timedelta(minutes=10)).cast("timestamp_ntz"))
    assert got.exceptAll(want).count() == 0
    assert closed.exceptAll(got).count() == 0


def test_late_rows_inside_the_watermark_count_and_beyond_it_are_dropped(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    schema = "account_id long, time_stamp timestamp_ntz"
    batches = [
        [(1, base + dt.timedelta(minutes=m)) for m in (1, 2, 14)],
        [(1, base + dt.timedelta(minutes=6)), (1, base + dt.timedelta(minutes=40))],
        [(1, base + dt.timedelta(minutes=3)), (1, base + dt.timedelta(minutes=80))],
    ]
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = windows.velocity(spark.readStream.schema(schema).parquet(folder), late="10 minutes")
        sinks.table_files(stream, out, checkpoint, once=True).awaitTermination()
    got = {r["window_start"].minute: r["transactions"] for r in spark.read.schema(stream.schema).parquet(out).collect()}
    assert got[0] == 2 and got[5] == 1 and got[10] == 1


def test_hourly_stream_equals_batch_for_closed_hours(spark, records, tmp_path):
    narrow = records.select("time_stamp", "fraud_class", "amount", "data_quality_score")
    narrow.write.parquet(str(tmp_path / "in"))
    stream = windows.hourly(spark.readStream.schema(narrow.schema).parquet(str(tmp_path / "in")))
    sinks.table_files(stream, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    got = {r["timestamp"]: r["total_transactions"] for r in spark.read.schema(stream.schema).parquet(str(tmp_path / "out")).collect()}
    want = {r["timestamp"]: r["total_transactions"] for r in windows.hourly(narrow).collect()}
    assert len(got) >= len(want) - 3
    assert all(want[k] == n for k, n in got.items())


def test_json_sink_folders_and_restart(spark, records, tmp_path):
    few = records.select("transaction_id", "amount", "processed_at").limit(200)
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    few.write.parquet(folder)
    for _ in range(2):
        stream = spark.readStream.schema(few.schema).parquet(folder)
        sinks.json_files(stream, out, checkpoint, once=True).awaitTermination()
    raw = files.read_json_text(spark, out)
    assert raw.count() == 200
    assert raw.where(~F.col("hour_bucket").rlike(r"^\d{4}-\d{2}-\d{2}--\d{2}$")).count() == 0


def test_quarantine_and_alert_streams(spark, messages, tmp_path):
    text = messages.where("value IS NOT NULL AND value != ''").select("value")
    text.write.text(str(tmp_path / "in"))
    source = tables.read_text_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    valid, rejected = decode.split_valid(source)
    kept = sinks.run_to_end(rejected, "quarantine-test")
    assert kept.count() == len(REJECTED) - 2
    record = features.feature_record(decode.typed(valid), F.col("created"))
    raised = sinks.run_to_end(features.alerts(record).select("transaction_id"), "alerts-test")
    assert raised.count() == 0


def test_change_log_survives_a_repeated_batch(spark, tmp_path):
    def line(i, lsn, deleted="false", amount=1.0):
        return json.dumps({"id": i, "amount": amount, "class": 0, "__deleted": deleted, "__table": "t", "__lsn": lsn, "__source_ts_ms": lsn})

    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    parts = [[line(1, 1), line(2, 2), line(3, 3)], [line(1, 5, amount=9.0), line(2, 6, "true"), line(1, 4, amount=7.0)]]
    for rows in parts:
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(folder)
        changes = decode.change_columns(tables.read_text_stream(spark, folder))
        sinks.append_images(changes, out, checkpoint, once=True).awaitTermination()
    live = {r["id"]: r["amount"] for r in sinks.read_latest(spark, out).collect()}
    assert live == {1: 9.0, 3: 1.0}


def test_change_log_of_fifty_batches(spark, tmp_path):
    """The folders a reader opens stay few, a repeated batch changes nothing, and old runs go."""
    schema = "id long, lsn long, deleted boolean, amount double"
    log = sinks.image_log(spark, str(tmp_path), schema, fan=3, small_rows=20, buckets=2)
    want = {}
    for number in range(50):
        rows = [((number * 7 + i * 3) % 40, number * 10 + i, (number + i) % 9 == 0, float(number)) for i in range(4)]
        want.update({r[0]: r for r in rows})
        for _ in range(2 if number % 20 == 7 else 1):
            log.sweep((number, 0))
            runs = log.manifest((number, 0))["runs"]
            made = log.add(spark.createDataFrame(rows, schema).coalesce(1), f"batch-{number:012d}")
            log.commit((number, 0), log.folded([*runs, made], (number, 0)), {"schema": schema})
        assert len(log.manifest()["runs"]) <= 6
    live = {r["id"]: (r["id"], r["lsn"], r["deleted"], r["amount"]) for r in sinks.read_latest(spark, str(tmp_path)).collect()}
    assert live == {k: v for k, v in want.items() if not v[2]}
    assert len(list((tmp_path / "runs").iterdir())) <= 25 and len(log._manifests()) <= 4
    assert log.manifest((30, 0)) == {"runs": [], "more": {}}


def test_readers_need_a_manifest(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sinks.read_latest(spark, str(tmp_path))
