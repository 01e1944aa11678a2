"""Secret scans: patterns over whole texts and over every layer that unwraps from them.

A text is the first layer of a worklist. Each layer is scanned for the three kinds of secrets, then unwrapped in
every way that applies, and what comes out joins the worklist:

* URL: all ``%XX`` runs at once, read as UTF-8;
* Unicode: all ``\\uXXXX``, ``\\UXXXXXXXX``, ``\\u{X}``, ``\\xXX`` escapes and numeric character references;
* base64: each run of 18 or more characters of the standard or the URL alphabet (also lines of one length as mail
  wraps them), at each of its four alignments;
* compressed: decoded bytes that are a gzip, zlib, bzip2, xz or Zstandard stream.

The worklist ends where nothing unwraps. A layer with the content and place of an earlier one is not visited again, so
streams that contain themselves end too. Every character of a layer knows the code points of the original text it came
from, so a find in any layer is given as a span of the original: for URL and Unicode to the character, in base64 to
the group of four characters, in a compressed stream as the whole run.

Kinds: ``assign`` (a name such as password or api_key, a sign, a value of 8 or more characters), ``access`` (AKIA, 16
or more in all), ``hex`` (32 or more). Finds of the first layer are the base; deeper ones are added unless they have
kind and span of an earlier one.

Defined cases: a null text is an empty one and has no secrets; repeated rows are scanned alike; other columns stay, one
named like the result is replaced. Bounds, against streams that inflate without end: a text unwraps to at most
``MAX_UNWRAPPED`` characters (16 times its own length if that is more); what lies beyond is not scanned and the row says so in
``cut_short``. The first layer is always scanned whole.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Kinds in their order, and the names, signs and characters of an assignment.
KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
VALUE_CHARS = 8
# Runs are maximal, so a least length in the pattern finds what filtering its matches would.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

MAX_UNWRAPPED = 16 << 20
RESULT = T.StructType().add("kind", "string").add("start", "integer").add("end", "integer").add("layers", "string")

URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{18,}")
WRAPPED_RUN = re.compile(r"(?:[A-Za-z0-9+/]{60,76}\r?\n)+[A-Za-z0-9+/]+")
TO_STANDARD = str.maketrans("-_", "+/", "\r\n")


@dataclass
class Layer:
    """A text, the code points of the original that each character stands for, and how it was reached."""

    text: str
    starts: np.ndarray | None  # None: the original itself
    ends: np.ndarray | None
    path: tuple[str, ...]
    raw: bytes | None = None

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start]), int(self.ends[end - 1])

    def bounds(self, start: int = 0, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """First and last code point (exclusive) of every character from ``start`` to ``end``."""
        if self.starts is None:
            at = np.arange(start, len(self.text) if end is None else end, dtype=np.int64)
            return at, at + 1
        return self.starts[start:end], self.ends[start:end]


def matches(text: str) -> Iterator[tuple[str, int, int]]:
    """Kind, start and end of every secret of one layer."""
    for m in ASSIGN.finditer(text):
        if len(m.group(2)) >= VALUE_CHARS:
            yield "assign", m.start(), m.end()
    for m in ACCESS.finditer(text):
        yield "access", m.start(), m.end()
    for m in HEX.finditer(text):
        yield "hex", m.start(), m.end()


def _replaced(layer: Layer, pattern: re.Pattern, pieces, name: str) -> Layer:
    """The layer with each match replaced by ``pieces(match)``: characters, each with its start and end in the layer."""
    starts, ends = layer.bounds()
    text, kept_starts, kept_ends, done = [], [], [], 0
    for m in pattern.finditer(layer.text):
        text.append(layer.text[done : m.start()])
        kept_starts.append(starts[done : m.start()])
        kept_ends.append(ends[done : m.start()])
        for char, a, b in pieces(m):
            text.append(char)
            kept_starts.append(starts[a : a + 1])
            kept_ends.append(ends[b - 1 : b])
        done = m.end()
    text.append(layer.text[done:])
    kept_starts.append(starts[done:])
    kept_ends.append(ends[done:])
    return Layer("".join(text), np.concatenate(kept_starts), np.concatenate(kept_ends), (*layer.path, name))


def _utf8_pieces(raw: bytes) -> Iterator[tuple[str, int, int]]:
    """Characters with their first and last byte (exclusive); a byte that is no UTF-8 stands for itself."""
    at = 0
    while at < len(raw):
        lead = raw[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        try:
            char = raw[at : at + size].decode()
        except UnicodeDecodeError:
            char, size = chr(lead), 1
        yield char, at, at + size
        at += size


def _url_pieces(m: re.Match) -> Iterator[tuple[str, int, int]]:
    for char, a, b in _utf8_pieces(bytes.fromhex(m.group().replace("%", ""))):
        yield char, m.start() + 3 * a, m.start() + 3 * b


def _escape_pieces(m: re.Match) -> Iterator[tuple[str, int, int]]:
    digits = next(g for g in m.groups() if g)
    code = int(digits, 10 if m.lastindex == 6 else 16)
    yield chr(code) if code < 0x110000 else "�", m.start(), m.end()


def _joined_surrogates(layer: Layer) -> Layer:
    """Pairs of surrogates from escapes as one character; single ones as the replacement character."""
    if not re.search("[\ud800-\udfff]", layer.text):
        return layer

    def pieces(m):
        yield (m.group().encode("utf-16", "surrogatepass").decode("utf-16") if len(m.group()) == 2 else "�"), m.start(), m.end()

    joined = _replaced(layer, re.compile("[\ud800-\udbff][\udc00-\udfff]|[\ud800-\udfff]"), pieces, "")
    return Layer(joined.text, joined.starts, joined.ends, layer.path)


def _of_bytes(raw: bytes, starts: np.ndarray, ends: np.ndarray, path: tuple[str, ...]) -> Layer:
    """A layer of bytes: UTF-8, or each byte a character where it is none."""
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return Layer(raw.decode("latin-1"), starts, ends, path, raw)
    if len(text) != len(raw):
        lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
        first = np.flatnonzero(lead)
        starts, ends = starts[first], ends[np.append(first[1:], len(raw)) - 1]
    return Layer(text, starts, ends, path, raw)


def _base64_layers(layer: Layer) -> Iterator[Layer]:
    runs = list(BASE64_RUN.finditer(layer.text))
    # Wrapped lines are runs of 60 or more characters themselves.
    for pattern in (None, WRAPPED_RUN) if any(m.end() - m.start() >= 60 for m in runs) else (None,):
        for m in pattern.finditer(layer.text) if pattern else runs:
            starts, ends = layer.bounds(m.start(), m.end())
            if pattern:
                digit = np.array([c not in "\r\n" for c in m.group()])
                starts, ends = starts[digit], ends[digit]
            digits = m.group().translate(TO_STANDARD)
            for shift in range(4):
                # Whole groups of four; a last group of two or three digits gives one or two bytes.
                cut = digits[shift:]
                cut = cut[: len(cut) - (len(cut) % 4 == 1)]
                raw = base64.b64decode(cut + "=" * (-len(cut) % 4))
                at = np.arange(len(raw))
                first, last = at // 3 * 4 + at % 3, at // 3 * 4 + at % 3 + 1
                yield _of_bytes(raw, starts[shift + first], ends[shift + last], (*layer.path, "base64"))


def _inflated(raw: bytes, limit: int) -> tuple[str, bytes, bool] | None:
    """Name of the compression, at most ``limit`` bytes, and whether that was all; None where the bytes are no stream."""
    try:
        if raw[:2] == b"\x1f\x8b" or (len(raw) > 2 and raw[0] & 15 == 8 and raw[0] >> 4 < 8 and (raw[0] << 8 | raw[1]) % 31 == 0):
            stream = zlib.decompressobj(zlib.MAX_WBITS | 32)
            out = stream.decompress(raw, limit)
            return ("gzip" if raw[0] == 0x1F else "zlib"), out, stream.eof or not stream.unconsumed_tail
        if raw[:3] == b"BZh":
            stream = bz2.BZ2Decompressor()
            return "bzip2", stream.decompress(raw, limit), stream.eof or stream.needs_input
        if raw[:6] == b"\xfd7zXZ\x00":
            stream = lzma.LZMADecompressor()
            return "xz", stream.decompress(raw, limit), stream.eof or stream.needs_input
        if raw[:4] == b"\x28\xb5\x2f\xfd":
            with zstandard.ZstdDecompressor().stream_reader(raw) as stream:
                out = stream.read(limit)
                return "zstd", out, not stream.read(1)
    except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError):
        return None
    return None


def _unwrapped(layer: Layer, left: int) -> Iterator[tuple[Layer, bool]]:
    """Layers one step deeper, and whether each is whole."""
    if layer.raw and (got := _inflated(layer.raw, max(1, left))):
        name, out, whole = got
        if out:
            start, end = layer.span(0, len(layer.text))
            yield _of_bytes(out, np.full(len(out), start), np.full(len(out), end), (*layer.path, name)), whole
    if "%" in layer.text and URL_RUN.search(layer.text):
        yield _replaced(layer, URL_RUN, _url_pieces, "url"), True
    if ESCAPE.search(layer.text):
        yield _joined_surrogates(_replaced(layer, ESCAPE, _escape_pieces, "unicode")), True
    for deeper in _base64_layers(layer):
        yield deeper, True


def find(text: str | None, max_unwrapped: int = MAX_UNWRAPPED) -> tuple[list[tuple[str, int, int, str]], bool]:
    """Secrets (kind, start, end, layers unwrapped) in order of start, then kind; and whether a bound cut the unwrapping."""
    text = text or ""
    found: dict[tuple[str, int, int], str] = {}
    left = max(max_unwrapped, 16 * len(text))
    seen, work, cut = set(), deque([Layer(text, None, None, ())]), False
    while work:
        layer = work.popleft()
        for kind, start, end in matches(layer.text):
            found.setdefault((kind, *layer.span(start, end)), "/".join(layer.path))
        for deeper, whole in _unwrapped(layer, left):
            cut |= not whole
            if not deeper.text:
                continue
            if len(deeper.text) > left:
                cut = True
                continue
            content = hashlib.blake2b(deeper.raw if deeper.raw is not None else deeper.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            key = (content, *deeper.span(0, len(deeper.text)))
            if key not in seen:
                seen.add(key)
                left -= len(deeper.text)
                work.append(deeper)
    order = sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return [(*s, found[s]) for s in order], cut


def scan(df: DataFrame, text: str = "text", into: str = "secrets", cut: str = "cut_short") -> DataFrame:
    """Add the secrets of every whole text, with the layers between each and the text ('' in the text itself)."""
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in (into.lower(), cut.lower())]
    rows = df.select(*kept)
    at = rows.columns.index(text)
    schema = T.StructType([*rows.schema.fields, T.StructField(into, T.ArrayType(RESULT)), T.StructField(cut, T.BooleanType())])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("layers", pa.string())]))
    names = ("kind", "start", "end", "layers")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [find(value.as_py()) for value in batch.column(at)]
            spans = pa.array([[dict(zip(names, s, strict=True)) for s in found] for found, _ in made], kind)
            flags = pa.array([short for _, short in made], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns, spans, flags], [*batch.schema.names, into, cut])

    return rows.mapInArrow(run, schema)


def as_text(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(df: DataFrame) -> DataFrame:
    """Per document: base finds by kind, the digest of the base spans, and all spans."""
    scanned = scan(df.select("doc_id", "text")).drop("text")
    base = F.filter("secrets", lambda s: s["layers"] == "")

    def of_kind(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of_kind(k) for k in KINDS]
    return scanned.select("doc_id", *counts, F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("secrets")).alias("spans"), "cut_short")
