"""Stored tables are shuffled and sorted as narrow rows, their text is packed, and a stream's files are bounded."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from checks import fixture as fx
from checks import queries
from txnlake.operators import ml, scale
from txnlake.streaming import features, sinks


def _widths(df, names):
    """Columns of every node of these kinds."""
    plan = df._jdf.queryExecution().executedPlan()
    todo, out = [plan.initialPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan], []
    while todo:
        node = todo.pop()
        if node.nodeName() in names:
            out.append(node.output().size())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return out


def test_stream_records_travel_as_events(spark, sf_dir):
    widths = _widths(fx.realtime_rolling(spark, sf_dir), {"Exchange", "Sort"})
    assert widths and max(widths) <= 20


def test_stream_text_is_packed(spark, sf_dir):
    path = fx.stream_raw(spark, sf_dir)
    stored = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path.removeprefix("file:")) for f in fs if f.startswith("part-"))
    text = queries.files.read_json_text(spark, path).agg(F.sum(F.length("json_data"))).first()[0]
    assert stored < text * 0.6


def test_rolling_by_row_key_sorts_narrow_rows(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "silver")
    plain, keyed = ml.build(rows, created_at=F.col("ts")), ml.build(rows, created_at=F.col("ts"), row_key="id")
    assert max(_widths(keyed, {"Sort"})) <= 12 < max(_widths(plain, {"Sort"}))
    assert keyed.columns == plain.columns
    assert keyed.exceptAll(plain).isEmpty() and plain.exceptAll(keyed).isEmpty()


def test_rolling_by_row_key_with_hot_keys(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("k"), F.sqrt("id").alias("x"), F.lit("t").alias("text"))
    kinds = {"m": "mean", "n": "rows"}
    plain = scale.rolling(df, ["k"], ["id"], 10, "x", kinds)
    keyed = scale.rolling(df, ["k"], ["id"], 10, "x", kinds, hot_rows=100, block_rows=50, row_key="id")
    assert keyed.columns == plain.columns
    want = {r["id"]: (r["k"], r["n"], round(r["m"], 9), r["text"]) for r in plain.collect()}
    assert {r["id"]: (r["k"], r["n"], round(r["m"], 9), r["text"]) for r in keyed.collect()} == want


def test_stream_reads_a_third_of_the_time_from_several_files(spark, sf_dir, monkeypatch):
    made, path_of = {}, queries.work_path

    def work_path(s, name):
        made[name] = path_of(s, name)
        return made[name]

    monkeypatch.setattr(queries, "work_path", work_path)
    monkeypatch.setattr(queries, "STREAM_FILE_ROWS", 100)
    got = queries.REGISTRY["st_rolling_100_stream"](spark, sf_dir)
    cols = ["transaction_id", *features.ROLLING_COLS]
    want = queries.rounded(fx.table(spark, sf_dir, "realtime").select(*cols))
    assert got.select(*cols).exceptAll(want).isEmpty() and want.exceptAll(got.select(*cols)).isEmpty()
    files = [f for f in os.listdir(made["records"].removeprefix("file:")) if f.endswith(".parquet")]
    rows = want.count()
    assert len(files) == 3 * (rows // 300 + 1)


def test_json_sink_deals_hours_to_all_tasks(spark, sf_dir, tmp_path):
    """An hour has at most ``writers`` files, all of them where it is busy; the tasks that write are not bounded by it."""
    rows = fx.table(spark, sf_dir, "realtime").select("transaction_id", "processed_at")
    busy = spark.range(400).select((F.col("id") + 10**9).alias("transaction_id"), F.lit(fx.AS_OF).cast("timestamp_ntz").alias("processed_at"))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows.unionByName(busy).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else little data is one task's
    try:
        sinks.json_files(stream, out, str(tmp_path / "cp"), once=True, writers=2).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = {d: [f for f in fs if f.startswith("part-")] for d, _, fs in os.walk(out) if "hour_bucket=" in d}
    assert max(len(fs) for fs in files.values()) == 2 == len(files[f"{out}/hour_bucket={fx.AS_OF[:10]}--00"])
    assert len({f.split("-")[1] for fs in files.values() for f in fs}) > 2
    assert queries.files.read_json_text(spark, out).count() == rows.count() + 400


def test_record_stream_reads_the_stored_table(spark, sf_dir, monkeypatch):
    """The stream's files are the table's own; only what a query writes is made."""
    made, path_of = [], queries.work_path
    monkeypatch.setattr(queries, "work_path", lambda s, name: made.append(name) or path_of(s, name))
    for name in ("st_file_sink", "st_checkpoint"):
        queries.REGISTRY[name](spark, sf_dir).count()
    assert made and "records" not in made


def test_table_stream_is_the_table(spark, sf_dir):
    stream = fx.table_stream(spark, sf_dir, "realtime")
    want = fx.table(spark, sf_dir, "realtime", dated=True)
    assert stream.schema.names == want.schema.names
    got = sinks.run_to_end(stream, "table-stream")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
