"""A keyed state in shared storage as a log of runs, for state that outgrows a micro-batch.

Every micro-batch appends one run: what it has to say about the keys it touched. A manifest names the live runs; writing
it is the switch that makes a batch's work visible, so readers see the state before or after a batch,
never between. Runs are folded when ``FAN`` of like size have gathered: a row is rewritten once per size class, what a
batch writes grows with the batch (and the logarithm of the state), and the number of live runs stays at most ``FAN`` per
size class. Runs are partitioned by a hash of the key, so that a batch reads only the buckets it touches.

A repeated micro-batch begins from the manifest before it and replaces its own runs. Folders named by none of the last
``KEPT`` manifests are deleted when the next batch begins.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.sources import shared

FAN = 8
SMALL_ROWS = 10_000  # all runs of up to so many rows are of one size class
BUCKETS = 32
KEPT = 3
BUCKET, RUN = "_bucket", "_run"


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_folders(spark: SparkSession, schema: str, root: str, names: list[str]) -> DataFrame:
    """Rows below ``<root>/_run=<name>`` of some names."""
    paths = [f"{root}/{RUN}={n}" for n in names]
    return spark.read.schema(f"{schema}, {RUN} STRING").option("basePath", root).parquet(*paths).drop(RUN)


@dataclass
class RunLog:
    """``fold`` leaves of the rows of a key those that count; folding folded rows again must change nothing."""

    spark: SparkSession
    path: str
    key: str
    schema: str
    fold: Callable[[DataFrame], DataFrame]
    buckets: int = BUCKETS
    fan: int = FAN
    small_rows: int = SMALL_ROWS

    # Manifests ------------------------------------------------------------------------------------

    def _manifests(self) -> list[tuple[int, int]]:
        """(batch, step) of all manifests, in order."""
        listed = [n.removesuffix(".json").split("-") for n in shared.names(self.spark, f"{self.path}/manifests") if n.endswith(".json")]
        return sorted((int(batch), int(step)) for batch, step in listed if not batch.startswith("."))

    def _file(self, at: tuple[int, int]) -> str:
        return f"{self.path}/manifests/{at[0]:012d}-{at[1]}.json"

    def manifest(self, before: tuple[int, int] | None = None) -> dict:
        """The newest manifest, or the newest one before a batch (and step)."""
        at = [m for m in self._manifests() if before is None or m < before]
        return shared.get_json(self.spark, self._file(at[-1])) if at else {"runs": [], "more": {}}

    def last(self) -> tuple[int, int] | None:
        """Batch and step of the newest manifest."""
        at = self._manifests()
        return at[-1] if at else None

    def commit(self, at: tuple[int, int], runs: list[dict], more: dict | None = None) -> None:
        shared.put_json(self.spark, self._file(at), {"runs": runs, "more": more or {}})

    def sweep(self, at: tuple[int, int]) -> None:
        """Before a batch: delete manifests but the last ``KEPT`` before it, and all folders that none of the others names."""
        found = self._manifests()
        before = [m for m in found if m < at]
        old = before[:-KEPT]
        needed: dict[str, set[str]] = {"runs": set(), "waiting": set()}
        for m in found:
            if m not in old:
                named = shared.get_json(self.spark, self._file(m))
                needed["runs"] |= {r["name"] for r in named["runs"]}
                needed["waiting"] |= {w["name"] for w in named["more"].get("waiting", [])}
        for m in old:
            shared.remove(self.spark, self._file(m))
        for folder, kept in needed.items():
            for name in shared.names(self.spark, f"{self.path}/{folder}"):
                if name.removeprefix(f"{RUN}=") not in kept:
                    shared.remove(self.spark, f"{self.path}/{folder}/{name}")

    # Runs -----------------------------------------------------------------------------------------

    def read(self, runs: list[dict], buckets: list[int] | None = None) -> DataFrame:
        """Rows of some runs; with ``buckets`` only their folders are read. Not folded."""
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        rows = read_folders(self.spark, f"{self.schema}, {BUCKET} INT", f"{self.path}/runs", [r["name"] for r in runs])
        return (rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets))).drop(BUCKET)

    def current(self) -> DataFrame:
        """The state of all keys, after the newest manifest."""
        return self.fold(self.read(self.manifest()["runs"]))

    def add(self, rows: DataFrame, name: str) -> dict:
        """Write rows, folded, as a run."""
        dealt = self.fold(rows).withColumn(BUCKET, bucket_of(self.key, self.buckets)).hint("rebalance", BUCKET)
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/runs/{RUN}={name}")
        # The number of rows comes from the files' footers.
        return {"name": name, "rows": self.read([{"name": name}]).count()}

    def _class(self, run: dict) -> int:
        return 0 if run["rows"] <= self.small_rows else 1 + int(math.log(run["rows"] / self.small_rows, self.fan))

    def folded(self, runs: list[dict], at: tuple[int, int]) -> list[dict]:
        """The runs, with those of every size class that has ``fan`` of them folded to one."""
        step = 0
        while True:
            by_class: dict[int, list[dict]] = {}
            for r in runs:
                by_class.setdefault(self._class(r), []).append(r)
            full = [c for c, members in sorted(by_class.items()) if len(members) >= self.fan]
            if not full:
                return runs
            members = by_class[full[0]]
            made = self.add(self.read(members), f"fold-{at[0]:012d}-{at[1]}-{step}")
            runs = [r for r in runs if r not in members] + [made]
            step += 1
