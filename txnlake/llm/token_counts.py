"""Token counts through a digest cache.

A text's key is the SHA-256 of its normalised content (null becomes empty; nothing else is changed, as any
other change could alter a count), a tokenizer's key the SHA-256 of its file. The cache holds one row
per content and tokenizer. Contents without a count are encoded once each and appended; then all documents
join the cache. Copies are folded before the shuffle, so a text that fills a third of the rows is
encoded once and moves once per task.

Tokenizer files: ``.json`` (tokenizers) and ``.model`` (sentencepiece). No special tokens are added,
strings of special tokens inside a text are handled as the library does by default, nothing is truncated or
padded.

Byte-level BPE without a normaliser never joins a word to what stands before the single space in front
of it, so such texts are cut at single spaces between other characters and the pieces counted through a
bounded memory of pieces: the sum equals the count of the whole text. Other tokenizers encode whole texts.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows and null ids each give a row;
columns of the input other than the id and the text do not matter; a cache with repeated rows is read as one.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm import common

OVER_LIMIT = 512
PIECES_KEPT = 400_000  # pieces remembered per worker process; then the memory starts anew
ENCODE_BYTES = 1 << 20  # text handed to the library at once
CACHE_SCHEMA = "content string, n_tokens long"
# Next to other white space a space can belong to the token before or after it.
_UNSAFE = re.compile(r"\s | \s|^ | $")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class Counter:
    """Counts tokens of texts with one tokenizer; lives in a worker process."""

    def __init__(self, path: str):
        self.memory: dict[str, int] = {}
        self.by_piece = False
        if path.endswith(".model"):
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.lengths = lambda texts: [len(x) for x in self.model.encode(texts, num_threads=1)]
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.lengths = lambda texts: [len(x) for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        before = kind.get("pre_tokenizer") or {}
        added = [t for t in kind.get("added_tokens", []) if t.get("lstrip") or t.get("rstrip") or " " in t.get("content", "")]
        self.by_piece = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not kind.get("normalizer") and not added

    def encoded(self, texts: list[str]) -> list[int]:
        """Token counts by the library, a bounded amount of text at a time."""
        out, held, size = [], [], 0
        for text in texts:
            held.append(text)
            size += len(text) + 16
            if size >= ENCODE_BYTES:
                out += self.lengths(held)
                held, size = [], 0
        return out + (self.lengths(held) if held else [])

    def count(self, texts: list[str]) -> list[int]:
        if not self.by_piece:
            return self.encoded(texts)
        cut = []
        for text in texts:
            if not text:
                cut.append([])
            elif _UNSAFE.search(text):
                first, *rest = _CUT.split(text)
                cut.append([first, *[" " + x for x in rest]])
            else:
                first, *rest = text.split(" ")
                cut.append([first, *map(" ".__add__, rest)])
        if len(self.memory) > PIECES_KEPT:
            self.memory.clear()
        known = self.memory
        missing = list(set().union(*cut).difference(known))
        known.update(zip(missing, self.encoded(missing), strict=True))
        return [sum(map(known.__getitem__, pieces)) for pieces in cut]


_counters: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def encode_missing(texts: DataFrame, path: str) -> DataFrame:
    """(content, text) to (content, n_tokens)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            counts = counter.count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["content", "n_tokens"])

    return texts.select("content", "text").mapInArrow(run, CACHE_SCHEMA)


def read_cache(spark, cache: str) -> DataFrame:
    """Stored counts, one row per content; empty if nothing is stored yet."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str, cache: str, doc_id: str = "doc_id", text: str = "text", limit: int = OVER_LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit, content.

    ``tokenizer``: a file every executor has at the same place. ``cache``: a folder all executors reach;
    counts are kept below it by tokenizer.
    """
    spark = docs.sparkSession
    own = f"{cache}/tokenizer={tokenizer_digest(tokenizer)}"
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.sha2(whole, 256).alias("content"), F.octet_length(whole).cast("long").alias("n_bytes"))
    stored = read_cache(spark, own)
    texts = docs.select(F.sha2(whole, 256).alias("content"), whole.alias("text")).groupBy("content").agg(F.first("text").alias("text"))
    cold = stored.isEmpty()
    # With a warm cache, see by digests alone whether any text has to move.
    if cold or not keyed.select("content").distinct().join(stored, "content", "left_anti").isEmpty():
        missing = texts if cold else texts.join(stored, "content", "left_anti")
        encode_missing(missing, tokenizer).write.mode("append").parquet(own)
    # Stored, one row per content: read plainly, the join can split a content that a third of the rows share.
    counts, _ = common.store(read_cache(spark, own).withColumnRenamed("content", "__content"), "token-counts")
    joined = keyed.join(counts, F.col("content") == F.col("__content"), "left")
    return joined.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "content")
