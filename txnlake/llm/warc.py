"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

``write_archives`` turns rows into ``.warc.zst`` files in a folder all executors reach and returns a
manifest; ``read_archives`` decodes them frame by frame, holding one record at a time, and validates
version line, required headers, lengths and digests. A file is written under another name and renamed
when whole; only files of the manifest are read, so what a lost executor left behind does not count.

Equal payloads: ``mark_revisits`` makes the row with the smallest id the response and all others revisits
of it. The ids per digest are folded before the shuffle and joined back, where Spark splits a digest
shared by a third of all rows.

Defined cases: a null payload is an empty one; payloads below ``LEAST_REVISITED`` bytes are all
responses; a null id is written as ``null``, is a response and is never referred to; rows that repeat the
smallest id are all responses; a null URL is left out; control characters and spaces in URLs are
percent-encoded; an empty table gives no archive and no rows; too few records for a dictionary give
an archive without one.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm import common
from txnlake.session import work_path

LEAST_REVISITED = 100
ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 16 << 10
SAMPLES, SAMPLE_BYTES = 200, 8 << 10  # records a dictionary is trained on, and bytes of each
LEVEL = 3
READ_BYTES = 16 << 10
# Fixed values of the format: magic number of the frame that holds the dictionary, of Zstandard frames.
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
VERSION, REQUIRED = b"WARC/1.1", ("WARC-Record-ID", "WARC-Type", "WARC-Date", "Content-Length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # the tables have no capture time
MANIFEST = "path string, records long, bytes long"
RECORD = "record_id string, record_type string, refers_to string, target_uri string, payload_bytes long, payload_digest string, payload binary"


class InvalidRecord(ValueError):
    """An archive that breaks the format."""


def mark_revisits(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_digest, record_type, refers_to) of every row."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    base = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), body.alias("payload"))
    base = base.withColumn("payload_digest", F.sha2("payload", 256))
    firsts = base.filter(F.octet_length("payload") >= LEAST_REVISITED).groupBy("payload_digest").agg(F.min("page_id").alias("__first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # Stored: read plainly, the join can split a digest that a third of the rows share.
    firsts, _ = common.store(firsts.withColumnRenamed("payload_digest", "__digest"), "warc-firsts")
    joined = base.join(firsts, F.col("payload_digest") == F.col("__digest"), "left")
    again = F.col("__first") < F.col("page_id")
    return joined.select("page_id", "url", "payload", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("__first")).alias("refers_to"))


def record_name(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def page_number(name: str | None) -> int | None:
    return None if name is None or name == "<urn:x-page:null>" else int(name[len("<urn:x-page:") : -1])


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record. A revisit keeps the HTTP header, which has the payload's length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    lines = [VERSION.decode(), f"WARC-Type: {kind}", f"WARC-Record-ID: {record_name(page_id)}", f"WARC-Date: {DATE}"]
    lines += [f"WARC-Target-URI: {_uri(url)}"] if url is not None else []
    lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_name(refers_to)}"] if kind == "revisit" else []
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from the first records, or none where there is too little to learn from."""
    samples = [r[:SAMPLE_BYTES] for r in records[:SAMPLES]]
    if len(samples) < 8 or sum(map(len, samples)) < 4 * DICTIONARY_BYTES:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:  # the samples have nothing in common
        return None


def archive_bytes(records: list[bytes]) -> Iterator[bytes]:
    """The parts of one archive."""
    learned = train(records)
    if learned is not None:
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(learned.as_bytes())
        yield struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=learned, write_checksum=True)
    for record in records:
        yield compressor.compress(record)


def write_archives(marked: DataFrame, folder: str, archive_size: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows of ``mark_revisits`` as archives; the stored manifest of whole files."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        part, held, size = TaskContext.get().partitionId(), [], 0

        def close() -> pa.RecordBatch:
            name = f"{root}/part-{part:05d}-{uuid.uuid4().hex}.warc.zst"
            with fs.open_output_stream(f"{name}.tmp", compression=None) as out:
                written = sum(out.write(x) for x in archive_bytes(held))
            fs.move(f"{name}.tmp", name)
            return pa.RecordBatch.from_arrays([pa.array([folder + name[len(root) :]]), pa.array([len(held)], pa.int64()), pa.array([written], pa.int64())], ["path", "records", "bytes"])

        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for row in zip(*columns, strict=True):
                held.append(record_bytes(*[x.as_py() for x in row]))
                size += len(held[-1])
                if size >= archive_size:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    manifest = marked.select("page_id", "url", "payload", "payload_digest", "record_type", "refers_to").mapInArrow(run, MANIFEST)
    return common.store(manifest, "warc-manifest")[0]


def load_dictionary(stream) -> tuple[zstandard.ZstdCompressionDict | None, bytes]:
    """The dictionary of the leading skippable frame, if there is one, and the bytes read beyond it."""
    head = stream.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != DICTIONARY_MAGIC:
        return None, head
    length = struct.unpack("<I", head[4:])[0]
    data = stream.read(length)
    if len(data) < length:
        raise InvalidRecord("the dictionary frame is cut short")
    if data[:4] == FRAME_MAGIC:
        data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
    return zstandard.ZstdCompressionDict(data), b""


def frames(stream) -> Iterator[bytes]:
    """Content of one frame after another; skippable frames beyond the first are passed over."""
    learned, rest = load_dictionary(stream)
    decompressor = zstandard.ZstdDecompressor(dict_data=learned)
    while True:
        rest = rest or stream.read(READ_BYTES)
        if not rest:
            return
        if len(rest) < 8:
            rest += stream.read(READ_BYTES)
        magic = struct.unpack("<I", rest[:4])[0] if len(rest) >= 4 else 0
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            skip = 8 + struct.unpack("<I", rest[4:8])[0]
            while len(rest) < skip:
                more = stream.read(READ_BYTES)
                if not more:
                    raise InvalidRecord("a skippable frame is cut short")
                rest += more
            rest = rest[skip:]
            continue
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            rest = rest or stream.read(READ_BYTES)
            if not rest:
                raise InvalidRecord("a frame is cut short")
            try:
                parts.append(frame.decompress(rest))
            except zstandard.ZstdError as error:
                raise InvalidRecord(f"not a frame: {error}") from error
            rest = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def parse_record(data: bytes) -> dict:
    """Check one record and take it apart."""
    head, found, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not found or first not in (b"WARC/1.0", VERSION):
        raise InvalidRecord(f"no record begins with {data[:20]!r}")
    headers = {}
    for line in lines:
        name, colon, value = line.decode().partition(":")
        if not colon:
            raise InvalidRecord(f"not a header: {line!r}")
        headers[name.strip().lower()] = value.strip()
    for name in REQUIRED:
        if name.lower() not in headers:
            raise InvalidRecord(f"{name} is missing")
    if not headers["content-length"].isdigit():
        raise InvalidRecord("Content-Length is no number")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise InvalidRecord(f"the block has {len(rest) - 4} bytes, its header says {length}")
    http, found, payload = rest[:length].partition(b"\r\n\r\n")
    said = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
    if not found or not said:
        raise InvalidRecord("the HTTP header has no length")
    kind, digest = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "response" and len(payload) != int(said[1]):
        raise InvalidRecord(f"the payload has {len(payload)} bytes, its header says {int(said[1])}")
    if kind == "revisit" and (payload or "warc-refers-to" not in headers):
        raise InvalidRecord("a revisit has a payload or refers to nothing")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise InvalidRecord("the payload does not have its digest")
    return {"record_id": headers["warc-record-id"], "record_type": kind, "refers_to": headers.get("warc-refers-to"), "target_uri": headers.get("warc-target-uri"), "payload_bytes": int(said[1]), "payload_digest": digest, "payload": payload if kind == "response" else None}


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the archives at ``path``; one archive per task. Broken archives raise."""
    columns = [c for c in RECORD.split(", ") if payloads or c != "payload binary"]
    names = [c.split()[0] for c in columns]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in columns]
    archives = manifest.count()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(held: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in held], k) for n, k in zip(names, kinds, strict=True)], names)

        for paths in batches:
            for path in paths.column(0).to_pylist():
                fs, place = pa.fs.FileSystem.from_uri(path)
                held, size = [], 0
                with fs.open_input_stream(place, compression=None) as stream:
                    for record in map(parse_record, frames(stream)):
                        held.append(record)
                        size += record["payload_bytes"] + 200 if payloads else 200
                        if size >= 4 << 20:
                            yield batch(held)
                            held, size = [], 0
                if held:
                    yield batch(held)

    return manifest.select("path").repartition(max(1, archives), "path").mapInArrow(run, ", ".join(columns))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all rows as archives and read them back, without the payloads."""
    folder = work_path(pages.sparkSession, "warc")
    return read_archives(write_archives(mark_revisits(pages), folder), payloads=False)
