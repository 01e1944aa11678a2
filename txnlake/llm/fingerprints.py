"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is the multiset of its paragraphs (lines, cut after sentences, and where still long after words that a
hash picks); an element is the digest of a
paragraph and of how many equal ones stand before it. Each element goes to one cell in each of three
thirds of the sketch; a cell keeps a count and the sums of its digests and of their checks. Sketches of two
versions subtract cell by cell, what they share vanishes, and peeling recovers the digests that
differ: a cell with one element left names it, and taking it out of its other cells frees more. If cells
stay, both versions are sketched again larger, until the peeling ends. The likeness of two sketches is
the share of common among all elements.

Documents are compared with the next one in descending order of id. Buckets of ids (cut at approximate
quantiles) are sorted; each bucket also gets the first document of the bucket after it, so that texts
move once and no task sees more than its bucket.

Defined cases: a null text is an empty one; empty texts have no paragraphs and are like each other
(likeness 1); null ids come last; rows that repeat an id follow one another in the order of their texts; a
table of one row is its own next document; of no rows, none.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm import common

CELLS = 15  # of a fingerprint; a multiple of 3
LONG = 240  # code points; longer paragraphs are cut at words that their hash picks
CUT_EVERY = 12  # words, on average
_U = np.uint64
_SALTS = np.array([[0xE7037ED1A0B428DB], [0x8EBC6AF09C88C6E3], [0x589965CC75374CC3]], np.uint64)
_THIRDS = np.arange(3, dtype=np.uint64)[:, None]


def paragraphs(text: str) -> list[str]:
    for mark in ".!?":
        text = text.replace(f"{mark} ", f"{mark}\n")
    out = []
    for p in text.split("\n"):
        if len(p) > LONG:
            out += _pieces(p)
        elif p:
            out.append(p)
    return out


def _pieces(paragraph: str) -> list[str]:
    """Cut after words of some hashes, so that an edit moves no cut but its own."""
    out, held = [], []
    for word in paragraph.split(" "):
        held.append(word)
        if zlib.crc32(word.encode()) % CUT_EVERY == 0:
            out.append(" ".join(held))
            held = []
    return [*out, " ".join(held)] if held else out


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0x9E3779B97F4A7C15)
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def elements(text: str) -> np.ndarray:
    """Distinct 64-bit digests: of a paragraph and the number of equal ones before it."""
    names = [xxhash.xxh64_intdigest(p.encode()) for p in paragraphs(text)]
    if len(set(names)) < len(names):
        seen: dict[int, int] = {}
        for i, name in enumerate(names):
            seen[name] = seen.get(name, -1) + 1
            if seen[name]:
                names[i] = xxhash.xxh64_intdigest(f"{name} {seen[name]}")
    return np.array(names, _U)


class Sketch:
    """Cells of an invertible Bloom lookup table; keys and checks are sums that wrap at 64 bits."""

    def __init__(self, counts: np.ndarray, keys: np.ndarray, checks: np.ndarray):
        self.counts, self.keys, self.checks = counts, keys, checks

    @classmethod
    def of(cls, digests: np.ndarray, cells: int) -> Sketch:
        made = cls(np.zeros(cells, np.int64), np.zeros(cells, _U), np.zeros(cells, _U))
        scattered = check(digests)
        where = places(scattered, cells)
        np.add.at(made.counts, where, 1)
        np.add.at(made.keys, where, _thrice(digests))
        np.add.at(made.checks, where, _thrice(scattered))
        return made

    def minus(self, other: Sketch) -> Sketch:
        return Sketch(self.counts - other.counts, self.keys - other.keys, self.checks - other.checks)

    def size(self) -> int:
        """Elements in the sketch: every third has each once."""
        return int(self.counts[: len(self.counts) // 3].sum())

    def text(self) -> str:
        return base64.b64encode(self.counts.astype("<i4").tobytes() + self.keys.astype("<u8").tobytes() + self.checks.astype("<u8").tobytes()).decode()

    @classmethod
    def parse(cls, text: str) -> Sketch:
        raw = base64.b64decode(text)
        cells = len(raw) // 20
        return cls(np.frombuffer(raw, "<i4", cells).astype(np.int64), np.frombuffer(raw, "<u8", cells, 4 * cells).astype(_U), np.frombuffer(raw, "<u8", cells, 12 * cells).astype(_U))

    def peel(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Digests only in the first and only in the second of two subtracted sketches; None if cells stay."""
        counts, keys, checks = self.counts.copy(), self.keys.copy(), self.checks.copy()
        cells = len(counts)
        ours, theirs = [], []
        while True:
            pure = np.flatnonzero(np.abs(counts) == 1)
            sign = counts[pure].astype(_U)  # -1 wraps, and so turns a wrapped sum back
            found, scattered = keys[pure] * sign, checks[pure] * sign
            real = check(found) == scattered
            if not real.any():
                break
            found, first = np.unique(found[real], return_index=True)
            sign, scattered = sign[real][first], scattered[real][first]
            ours.append(found[sign == 1])
            theirs.append(found[sign != 1])
            where = places(scattered, cells)
            np.subtract.at(counts, where, _thrice(sign.astype(np.int64)))
            np.subtract.at(keys, where, _thrice(found * sign))
            np.subtract.at(checks, where, _thrice(scattered * sign))
        if counts.any() or keys.any() or checks.any():
            return None
        empty = np.empty(0, _U)
        return np.concatenate([empty, *ours]), np.concatenate([empty, *theirs])


def check(digests: np.ndarray) -> np.ndarray:
    return _mix(digests ^ _U(0xA0761D6478BD642F))


def places(scattered: np.ndarray, cells: int) -> np.ndarray:
    """The cell of every digest in each third, from its check."""
    third = cells // 3
    return (((scattered * _SALTS) >> _U(32)) % _U(third) + _THIRDS * _U(third)).astype(np.int64).ravel()


def _thrice(values: np.ndarray) -> np.ndarray:
    return np.concatenate((values, values, values))


def difference(a: np.ndarray, b: np.ndarray, first: tuple[Sketch, Sketch] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Elements only in ``a`` and only in ``b``: from the given sketches, else from larger ones."""
    if first is not None and (found := first[0].minus(first[1]).peel()) is not None:
        return found
    # Twice the cells that all elements of both would need, then ever more.
    cells = 3 * max(2 * CELLS // 3, (len(a) + len(b)) // 2)
    while (found := Sketch.of(a, cells).minus(Sketch.of(b, cells)).peel()) is None:
        cells = 2 * cells + 3
    return found


def likeness(a: np.ndarray, b: np.ndarray, sketches: tuple[Sketch, Sketch]) -> float:
    """Common elements as a share of all."""
    ours, theirs = difference(a, b, sketches)
    common_count = len(a) - len(ours)
    everything = common_count + len(ours) + len(theirs)
    return common_count / everything if everything else 1.0


def edit(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the next text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


FINGERPRINT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _sketched(text: str) -> tuple[np.ndarray, Sketch]:
    digests = elements(text)
    return digests, Sketch.of(digests, CELLS)


def in_order(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(bucket, doc_id, text, tail), each bucket in one partition and sorted; ``tail``: the row only ends the bucket."""
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / parts for k in range(1, parts)]
    cuts = sorted(set(base.agg(F.percentile_approx("doc_id", shares, 10_000).alias("c")).first()["c"] or [])) if shares else []
    # Larger ids come first; null ids are a bucket of their own at the end.
    bucket = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<bigint>"), lambda c: F.col("doc_id") <= c)))
    keyed = base.withColumn("bucket", bucket)
    heads = keyed.groupBy("bucket").agg(F.max("doc_id").alias("head")).orderBy("bucket").collect()  # one row per bucket
    ends = [(heads[i - 1]["bucket"], heads[i]["bucket"], heads[i]["head"]) for i in range(len(heads))]
    ends = spark.createDataFrame(ends, "to_bucket int, from_bucket int, head long")
    tails = keyed.join(F.broadcast(ends), (F.col("bucket") == F.col("from_bucket")) & F.col("doc_id").eqNullSafe(F.col("head")))
    tails = tails.groupBy("to_bucket", "doc_id").agg(F.min("text").alias("text")).select(F.col("to_bucket").alias("bucket"), "doc_id", "text", F.lit(True).alias("tail"))
    rows = keyed.select("bucket", "doc_id", "text", F.lit(False).alias("tail")).unionByName(tails)
    return rows.repartition(parts, "bucket").sortWithinPartitions("bucket", "tail", F.col("doc_id").desc_nulls_last(), "text")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its sketch, its edited text's, and how like they and the next document's are."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # bucket, id, text, elements and sketch of the row that waits for its next
        for batch in batches:
            made = []
            for bucket, number, own, tail in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                digests, sketch = _sketched(own)
                if held is not None and held[0] == bucket:
                    _, waiting, before, a, one = held
                    changed = edit(before, own)
                    b, two = _sketched(changed)
                    made.append((waiting, len(before), hashlib.sha256(changed.encode()).hexdigest(), one.text(), two.text(), likeness(a, b, (one, two)), likeness(a, digests, (one, sketch))))
                held = None if tail else (bucket, number, own, digests, sketch)
            yield from common.rows(made, _ARROW).to_batches()

    return in_order(docs, doc_id, text).select("bucket", "doc_id", "text", "tail").mapInArrow(run, FINGERPRINT)
