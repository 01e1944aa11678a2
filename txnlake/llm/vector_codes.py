"""Vector code compression: product quantization with slice-and-intersect bitmasks.

A vector becomes whole numbers floor(256 * x), cut into ``parts`` equal consecutive parts; each part position has
a codebook of at most 64 entries. The nearest entry is found without comparing all of them: per dimension the
entries' coordinates are sorted and carry prefix masks (the entries before each place, one bit each), so the entries
within a radius of a coordinate are the difference of two masks. ANDed over the dimensions they are exactly the
entries in the box around the point. Only these are measured. The best of them is the nearest entry if its distance
is within the radius; else the radius grows to that distance (or doubles where the box is empty) and the point asks again.

Codebooks are learnt in rounds: tasks fold sums and counts per part position, entry and dimension, Spark adds
them up, and 64 x dimensions sums reach the driver. Vectors are never shuffled or gathered; a codebook has 64 x dimensions
numbers, which is what is sent to the tasks.

Defined cases. Rows whose vector is null, empty or holds a null, NaN or infinite component are dropped, and so are
those whose length is no multiple of ``parts`` or differs from the length that the smallest id left has. A null id is
coded but seeds no codebook; of a repeated id the smallest vector seeds. With fewer than 64 ids the codebook is shorter;
without any, code and errors are null. Ties go to the lower index. Numbers too large for 64-bit squares are computed as
Python integers, exactly; an error above the largest long is given as that. An empty table gives no rows. Other columns stay,
those named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.llm import common
from txnlake.operators import scale

PARTS = 16
ENTRIES = 64
ROUNDS = 2
LONG_MAX = (1 << 63) - 1
# Sums travel as digits of this many bits, so that Spark's long sums neither round nor overflow.
LIMB_BITS = 32


def whole(values: np.ndarray) -> np.ndarray:
    """floor(256 * x), exactly: 64-bit where it fits, else Python integers."""
    wide = values.astype(np.float64)
    if not wide.size or np.abs(wide).max() < 2.0**54:
        return np.floor(wide * 256.0).astype(np.int64)
    flat = [int(v) * 256 if abs(v) >= 2.0**54 else math.floor(v * 256.0) for v in wide.ravel().tolist()]
    return np.array(flat, dtype=object).reshape(wide.shape)


def _same_kind(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers where squared distances, 64 fold, fit into them; else as Python integers."""
    if a.dtype != object and b.dtype != object:
        most = max((int(np.abs(x).max()) for x in (a, b) if x.size), default=0)
        if most < 1 << 50 and a.shape[-1] * most * most < 1 << 52:
            return a, b
    return a.astype(object), b.astype(object)


def _root_above(d2: np.ndarray) -> np.ndarray:
    """A whole number whose square is at least ``d2``."""
    if d2.dtype == object:
        return np.array([math.isqrt(v) + 1 for v in d2], dtype=object)
    return np.sqrt(d2.astype(np.float64)).astype(np.int64) + 2


class SliceIndex:
    """Nearest entry of one codebook (entries x dimensions, at most 64 entries)."""

    def __init__(self, entries: np.ndarray):
        if not 0 < len(entries) <= 64:
            raise ValueError("a codebook has 1 to 64 entries, a bit each")
        self.entries = entries
        bits = np.uint64(1) << np.arange(len(entries), dtype=np.uint64)
        self.sorted, self.prefix = [], []
        for j in range(entries.shape[1]):
            order = np.argsort(entries[:, j], kind="stable")
            self.sorted.append(entries[order, j])
            self.prefix.append(np.concatenate([[np.uint64(0)], np.bitwise_or.accumulate(bits[order])]))
        self.radius = self._spacing()

    def _spacing(self) -> int:
        """The initial radius: the median distance of an entry to its nearest other one."""
        if len(self.entries) < 2:
            return 1
        a, b = _same_kind(self.entries, self.entries)
        gaps = ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)
        nearest = sorted(min(int(g) for k, g in enumerate(row) if k != i) for i, row in enumerate(gaps))
        return math.isqrt(nearest[len(nearest) // 2]) + 1

    def masks(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Per point the entries whose every coordinate lies within its radius, as bits."""
        out = np.full(len(points), np.uint64(0xFFFFFFFFFFFFFFFF))
        for j, (values, prefix) in enumerate(zip(self.sorted, self.prefix, strict=True)):
            x = points[:, j]
            low, high = np.searchsorted(values, x - radius, "left"), np.searchsorted(values, x + radius, "right")
            out &= prefix[high] ^ prefix[low]
        return out

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties to the lower) and the squared distance, for each point."""
        points, entries = _same_kind(points, self.entries)
        index, best = np.zeros(len(points), np.int64), np.zeros(len(points), points.dtype)
        todo = np.arange(len(points))
        radius = np.full(len(points), self.radius, points.dtype)
        while len(todo):
            x, r = points[todo], radius[todo]
            masks = self.masks(x, r)
            bits = np.unpackbits(masks.astype("<u8").view(np.uint8).reshape(len(todo), 8), axis=1, bitorder="little")
            row, entry = np.nonzero(bits)
            grown = 2 * r + 1
            done = np.zeros(len(todo), bool)
            if len(row):
                gap = x[row] - entries[entry]
                key = (gap * gap).sum(axis=1) * 64 + entry
                starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                least, at = np.minimum.reduceat(key, starts), row[starts]
                d2 = least // 64
                sure = d2 <= r[at] * r[at]
                hit = at[sure.astype(bool)]
                index[todo[hit]] = (least[sure.astype(bool)] % 64).astype(np.int64)
                best[todo[hit]] = d2[sure.astype(bool)]
                done[hit] = True
                grown[at] = _root_above(d2)
            radius[todo] = grown
            todo = todo[~done]
        return index, best


@dataclass
class Codebooks:
    """Per part position its entries: whole numbers, entries x dimensions of a part."""

    entries: list[np.ndarray]
    dims: int

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for e in self.entries for v in e.ravel()).encode()).hexdigest()

    def indexes(self) -> list[SliceIndex]:
        return [SliceIndex(e) for e in self.entries if len(e)]


def usable(df: DataFrame, vector: str, parts: int = PARTS) -> DataFrame:
    """Rows with finite components whose number is a multiple of ``parts``."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return df.where(x.isNotNull() & (F.size(x) > 0) & (F.size(x) % parts == 0) & ~bad)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return whole(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims))


def _assign(indexes: list[SliceIndex], x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Part position, its points, their nearest entries and squared distances."""
    width = x.shape[1] // len(indexes)
    for part, index in enumerate(indexes):
        points = x[:, part * width : (part + 1) * width]
        yield part, points, *index.nearest(points)


SUMS = "part int, entry int, dim int, limb int, total long"


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    sign, rest, place = (-1 if value < 0 else 1), abs(value), 0
    while rest:
        if digit := rest & ((1 << LIMB_BITS) - 1):
            yield place, sign * digit
        rest >>= LIMB_BITS
        place += 1


def partition_sums(df: DataFrame, vector: str, books: Codebooks) -> DataFrame:
    """Counts (dimension -1) and componentwise sums of the points nearest to each entry, folded within tasks."""
    dims, entries = books.dims, books.entries

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = Codebooks(entries, dims).indexes()
        width = dims // len(indexes)
        counts = np.zeros((len(indexes), ENTRIES), np.int64)
        sums = np.zeros((len(indexes), ENTRIES, width), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0), dims)
            # 2^23 rows of a batch and 2^39 per value fit; beyond, and once sums grow, Python integers.
            if sums.dtype != object and (x.dtype == object or int(np.abs(x).max()) >= 1 << 39 or int(np.abs(sums).max(initial=0)) >= 1 << 62):
                sums = sums.astype(object)
            for part, points, nearest, _ in _assign(indexes, x):
                np.add.at(sums[part], nearest, points.astype(sums.dtype))
                counts[part] += np.bincount(nearest, minlength=ENTRIES)
        made = [(p, e, -1, limb, v) for p, e in zip(*np.nonzero(counts), strict=True) for limb, v in _limbs(int(counts[p, e]))]
        made += [(p, e, d, limb, v) for p, e in zip(*np.nonzero(counts), strict=True) for d in range(width) for limb, v in _limbs(int(sums[p, e, d]))]
        columns = list(zip(*made, strict=True)) or [()] * 5
        kinds = [pa.int32()] * 4 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([int(v) for v in c], k) for c, k in zip(columns, kinds, strict=True)], ["part", "entry", "dim", "limb", "total"])

    return df.select(vector).mapInArrow(run, SUMS)


def seeds(rows: DataFrame, vector: str, id_col: str, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The first codebooks: the parts of the vectors with the smallest ids (at most 64 rows reach the driver)."""
    known = rows.where(F.col(id_col).isNotNull())
    smallest = known.groupBy(id_col).agg(F.min(vector).alias("v")).orderBy(id_col)
    ids = [r[0] for r in known.select(id_col).distinct().orderBy(id_col).limit(entries).collect()]
    if not ids:
        return Codebooks([np.zeros((0, 1), np.int64)] * parts, 0)
    first = [r["v"] for r in smallest.where(F.col(id_col).isin(ids)).collect()]
    dims = len(first[0])
    x = whole(np.array([v for v in first if len(v) == dims], dtype=np.float64))
    return Codebooks(np.split(x, parts, axis=1), dims)


def train(df: DataFrame, vector: str = "embedding", id_col: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks from all rows: seeds, then ``rounds`` of assignment and componentwise floor means."""
    rows = usable(df, vector, parts)
    books = seeds(rows, vector, id_col, parts, entries)
    if books.dims:
        # Seeds of other lengths than the first are dropped with their rows: take the seeds among its length.
        rows = rows.where(F.size(vector) == books.dims)
        if len(books.entries[0]) < entries:
            books = seeds(rows, vector, id_col, parts, entries)
    for _ in range(rounds if books.dims else 0):
        folded = partition_sums(rows, vector, books).groupBy("part", "entry", "dim", "limb").agg(F.sum("total").alias("total"))
        totals: dict[tuple[int, int, int], int] = {}
        for r in folded.collect():
            key = (r["part"], r["entry"], r["dim"])
            totals[key] = totals.get(key, 0) + (r["total"] << (LIMB_BITS * r["limb"]))
        fresh = [e.astype(object) for e in books.entries]
        for (part, entry, dim), n in totals.items():
            if dim < 0:
                fresh[part][entry] = [totals.get((part, entry, d), 0) // n for d in range(fresh[part].shape[1])]
        small = all(abs(int(v)) < 1 << 62 for e in fresh for v in e.ravel())
        books = Codebooks([e.astype(np.int64) for e in fresh] if small else fresh, books.dims)
    return books


def encode(df: DataFrame, books: Codebooks, vector: str = "embedding", parts: int = PARTS) -> DataFrame:
    """The usable rows without their vector, with ``code`` (two hex digits per part) and ``error`` (squared distances summed)."""
    rows = usable(df, vector, parts)
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in (vector.lower(), "code", "error")]
    if not books.dims:
        return rows.select(*kept, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    rows = rows.where(F.size(vector) == books.dims).select(*kept, F.col(vector))
    schema = T.StructType(rows.schema.fields[:-1]).add("code", "string").add("error", "long")
    dims, entries = books.dims, books.entries

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = Codebooks(entries, dims).indexes()
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, error = np.zeros((batch.num_rows, len(indexes)), np.uint8), 0
            for part, _, nearest, d2 in _assign(indexes, _matrix(batch.column(batch.num_columns - 1), dims)):
                codes[:, part] = nearest
                error = error + d2.astype(object)
            made = [pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array([min(int(e), LONG_MAX) for e in error], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*batch.schema.names[:-1], "code", "error"])

    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, books: Codebooks, code: str = "code", into: str = "approximation") -> DataFrame:
    """The vectors that the codes stand for, as doubles."""
    table = F.array(*[F.array(*[F.array(*[F.lit(float(v) / 256.0) for v in e]) for e in part]) for part in books.entries])
    number = lambda p: F.conv(F.substring(F.col(code), p * 2 + 1, 2), 16, 10).cast("int")
    return df.withColumn(into, F.flatten(F.array(*[F.get(F.get(table, F.lit(p)), number(p)) for p in range(len(books.entries))])))


def compressed(df: DataFrame, vector: str = "embedding", id_col: str = "vec_id", label: str = "label") -> DataFrame:
    """Train, encode, and add ``label_error`` (errors summed over equal labels, nulls together) and ``codebooks_sha256``."""
    books = train(df, vector, id_col)
    names = ("label_error", "codebooks_sha256")
    coded, _ = common.store(encode(df.drop(*[c for c in df.columns if c.lower() in names]), books, vector), "vector-codes")
    most = F.lit(LONG_MAX).cast("decimal(38,0)")
    errors = F.sum(F.col("error").cast("decimal(38,0)"))
    total = F.when(errors > most, most).otherwise(errors).cast("long")
    size = common.free_name(coded, "rows_of_label")
    totals = coded.groupBy(label).agg(F.count(F.lit(1)).alias(size), total.alias("label_error"))
    return scale.join_by_value(coded, totals, label, size).withColumn("codebooks_sha256", F.lit(books.sha256))
