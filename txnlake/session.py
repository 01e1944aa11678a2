"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from txnlake.sources import shared

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Static options for a session builder: no call-site capture per column expression, which is most of
# the driver time of building wide plans.
BUILDER_OPTIONS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}
# Where a local master has no folder set.
LOCAL_DIR = "/tmp/txnlake"
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)
# Called when the work folder goes, by whoever remembers paths below it.
ON_RELEASE: list = []


def configure(spark: SparkSession) -> SparkSession:
    """Set the session options the operators rely on (all of them runtime SQL options)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # The widest method HotSpot compiles: wider stages run as smaller functions instead, which for
    # rows of 28 derived columns is several times faster than one interpreted method.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; ``LOCAL_DIR`` only where none is set and the master is local, as in a trial."""
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    return LOCAL_DIR


def work_path(spark: SparkSession, name: str) -> str:
    """A new path for one run, below the shared folder (inside :func:`scratch` below its folder)."""
    root = _scratch.get() or f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Whatever is stored inside goes at the end: for steps that are repeated without end, as micro-batches are."""
    path = work_path(spark, "scratch")
    before = _scratch.set(path)
    try:
        yield path
    finally:
        _scratch.reset(before)
        shared.remove(spark, path)


def release(spark: SparkSession) -> None:
    """Delete this application's own work folder below the shared folder."""
    shared.remove(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    for forget in ON_RELEASE:
        forget()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written files survive lost executors, fix values that depend on the physical layout
    (such as a position after a global sort) and let later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
