"""What the operators share: tables, intermediate storage, text batches and bucketed questions.

Text batches. Operators that must look up something for nearly every word or byte of the corpus cut
the documents into batches of about ``BATCH_BYTES`` of text (one row each, stored once). A batch
asks for its *distinct* keys only; the questions go to buckets of keys (a shuffle by bucket), a
bucket answers all batches at once, and the answers return to their batch by its number. A key
that fills a third of the corpus is asked once per batch, so no bucket grows with its frequency.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.session import work_path

BATCH_BYTES = 16 << 20
BUCKET_BYTES = 8 << 20
ASK_SCHEMA = "batch long, bucket int, payload binary"


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime options: small Arrow batches for long texts, and shuffle files that go once a job's result is stored."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write to the cluster's shared folder and read back: cuts lineage and survives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have, compared as Spark does: without case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def remainder_of_id(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def frame(**arrays: np.ndarray) -> bytes:
    """Named arrays as one compressed Arrow message."""
    columns = [pa.array([a], type=pa.large_list(pa.from_numpy_dtype(a.dtype))) if len(a) < 1024 else _listed(a) for a in arrays.values()]
    batch = pa.RecordBatch.from_arrays(columns, names=list(arrays))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _listed(a: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array([0, len(a)], pa.int64()), pa.array(a))


def unframe(payload: bytes) -> dict[str, np.ndarray]:
    batch = pa.ipc.open_stream(payload).read_next_batch()
    return {name: batch.column(i).values.to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)}


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def text_batches(docs: DataFrame, text: str, encode: Callable[[pa.Table], bytes], batch_bytes: int | None = None) -> DataFrame:
    """One row per batch: its number, its bytes of text, and what ``encode`` makes of its rows."""
    at = docs.columns.index(text)
    limit = batch_bytes or BATCH_BYTES

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, size, number = [], 0, 0

        def row(made):
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) | number], pa.int64()), pa.array([size], pa.int64()), pa.array([encode(pa.Table.from_batches(made))], pa.binary())], ["batch", "bytes", "blob"])

        for batch in batches:
            if not batch.num_rows:
                continue
            # Cut inside an Arrow batch too, so that very long texts do not pile up.
            ends = np.cumsum([len(x) for x in text_bytes(batch.column(at))])
            begun = 0
            while begun < batch.num_rows:
                done = ends[begun - 1] if begun else 0
                stop = min(batch.num_rows, max(begun + 1, int(np.searchsorted(ends, done + limit - size, "right"))))
                held.append(batch.slice(begun, stop - begun))
                size += int(ends[stop - 1] - done)
                begun = stop
                if size >= limit or begun < batch.num_rows:
                    yield row(held)
                    held, size, number = [], 0, number + 1
        if held:
            yield row(held)

    return docs.mapInArrow(cut, "batch long, bytes long, blob binary")


def bucket_count(batches: DataFrame) -> int:
    """Buckets of about ``BUCKET_BYTES`` of text each."""
    total = batches.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first()["n"]
    return max(int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / BUCKET_BYTES))


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that brings keys of a bucket together, and where each bucket begins and ends in it."""
    which = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(which, kind="stable")
    return order, np.searchsorted(which[order], np.arange(buckets + 1))


def questions(batch: int, arrays: dict[str, np.ndarray], keys: str, buckets: int, shift: int = 0) -> list[tuple[int, int, bytes]]:
    """Rows (batch, bucket, payload) that carry the named arrays to the buckets of their keys."""
    return questions_of(batch, [(keys, arrays)], buckets, shift)


def questions_of(batch: int, asked: list[tuple[str, dict[str, np.ndarray]]], buckets: int, shift: int = 0) -> list[tuple[int, int, bytes]]:
    """Questions of several kinds (name of the keys, arrays), each to the buckets of its keys, in one row per bucket."""
    dealt = []
    for keys, arrays in asked:
        order, edges = by_bucket(arrays[keys], buckets)
        dealt.append((edges, {name: a[order] for name, a in arrays.items()}))
    filled = np.flatnonzero(sum(np.diff(edges) for edges, _ in dealt))
    return [(batch, int(b) + shift, frame(**{name: a[edges[b] : edges[b + 1]] for edges, arrays in dealt for name, a in arrays.items()})) for b in filled]


def answered(keys: np.ndarray, buckets: int, answers: dict[int, dict[str, np.ndarray]], names: dict[str, type], shift: int = 0) -> dict[str, np.ndarray]:
    """Answers back in the order of ``keys``."""
    order, edges = by_bucket(keys, buckets)
    out = {name: np.zeros(len(keys), kind) for name, kind in names.items()}
    for b in range(buckets):
        if edges[b] < edges[b + 1]:
            got = answers[b + shift]
            for name in names:
                out[name][order[edges[b] : edges[b + 1]]] = got[name]
    return out


def rows(made: list[tuple], schema: pa.Schema) -> pa.Table:
    """A table of the given tuples."""
    columns = list(zip(*made, strict=True)) if made else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


ASK = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary())])


def ask_each(batches: DataFrame, ask: Callable[[int, bytes], list[tuple[int, int, bytes]]]) -> DataFrame:
    """Questions of every batch: ``ask(batch, blob)`` gives rows of ``ASK_SCHEMA``."""

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for batch, blob in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                yield from rows(ask(batch, blob.as_py()), ASK).to_batches()

    return batches.select("batch", "blob").mapInArrow(run, ASK_SCHEMA)


def answer_each(asked: DataFrame, answer: Callable[[int, list[int], list[dict[str, np.ndarray]]], list[tuple]], schema: str, arrow: pa.Schema) -> DataFrame:
    """Bring each bucket's questions together. ``answer(bucket, batches, questions)`` gives rows of ``schema``."""

    def run(key: tuple, got: pa.Table) -> pa.Table:
        order = np.argsort(got.column("batch").to_numpy(), kind="stable")
        numbers, payloads = got.column("batch").to_pylist(), got.column("payload")
        return rows(answer(key[0].as_py(), [numbers[i] for i in order], [unframe(payloads[int(i)].as_py()) for i in order]), arrow)

    return asked.groupBy("bucket").applyInArrow(run, schema)


def with_answers(batches: DataFrame, answers: DataFrame, use: Callable[[int, bytes, dict[int, dict[str, np.ndarray]]], pa.Table], schema) -> DataFrame:
    """Bring the answers back to their batch: ``use(batch, blob, answers by bucket)``."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = {b: unframe(p.as_py()) for b, p in zip(right.column("bucket").to_pylist(), right.column("payload"), strict=True)}
        return use(left.column("batch")[0].as_py(), left.column("blob")[0].as_py(), got)

    return batches.select("batch", "blob").groupBy("batch").cogroup(answers.select("batch", "bucket", "payload").groupBy("batch")).applyInArrow(run, schema)
