"""Benchmark decontamination: a BM25 index of the test items, searched with block-max WAND.

Items become an inverted index; every passage of every training text is a query, and all items whose
score reaches ``LEAST_SCORE`` are found. A posting's impact is its BM25 weight as a share of the item's own
score (that of the item as a query), so a passage with the whole item scores 1 and one threshold
serves all items. Items are put in classes by their length, powers of two from ``LEAST_WIDTH`` words, with an index
each. Passages are windows of twice the class's length, every half window, so each item-long stretch
lies whole in one; what is found of an item depends on the item and the text only, not on its shard or the other
items in it. Items of like length share a block. For all passages of some texts at once, the greatest
impacts of a passage's words are added up per block; a passage goes on only if some block reaches the
threshold. Then block-max WAND walks its postings and skips blocks whose greatest impacts do not add up.

A find is verified on words: of the item's question and of its answer at least ``LEAST_OVERLAP`` of the
``GRAM``-word sequences must stand in the passage, or of the whole item ``WHOLE_OVERLAP``, so that a leak cut or
edited at its end is found too. The answer is the last sentence of an item's text; one of no more than ``GRAM``
words is compared word by word.

Word statistics cover all items. The index is cut into shards of at most ``SHARD_WORDS`` words, each broadcast
in turn, so what is broadcast is bounded whatever the benchmark's size; a scan searches all classes of a shard.

Defined cases: null and empty texts match nothing, as do items without a word; equal items are each
reported; repeated rows and null ids are searched like others (rows with equal ids are reported as one); an
item of one sentence has no answer to check; longer parts of an item than a text are no match.
"""

from __future__ import annotations

import itertools
import math
import pickle
import re
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm import common

K1, B = 1.2, 0.75
LEAST_SCORE, LEAST_OVERLAP, GRAM = 0.5, 0.5, 5
WHOLE_OVERLAP = 0.8  # of question and answer together, whatever the answer's own
BLOCK = 4  # items
SHARD_WORDS = 50_000
LEAST_WIDTH = 64  # words of the shortest class; shorter passages would cost more than they tell apart
GROUP_WORDS = 40_000  # of texts whose passages are made together, whole texts at least
CELLS = 1 << 24  # (word, window, block) bounds added up at once
# A-Z to lower case, punctuation to space, so that glued marks do not hide a word.
_FOLD = bytes.maketrans(string.ascii_uppercase.encode() + string.punctuation.encode(), string.ascii_lowercase.encode() + b" " * len(string.punctuation))
_LAST_SENTENCE = re.compile(r"(?s)^(.*[.!?\n])\s*(\S.*)$")


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """Words before the last sentence, and of it; an item of one sentence is all question."""
    found = _LAST_SENTENCE.match(text.strip())
    parts = found.groups() if found else (text, "")
    question, answer = (words(p.encode()) for p in parts)
    return (question, answer) if question else (answer, [])


def grams(of: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return set(zip(*[of[i:] for i in range(n)], strict=False))


def width(n: int) -> int:
    """Length of the class of items of ``n`` words: the power of two they fit in, ``LEAST_WIDTH`` at least."""
    return max(LEAST_WIDTH, 1 << max(n - 1, 0).bit_length())


class Part:
    """A question, an answer or both, to be found in passages."""

    def __init__(self, of: list[bytes], n: int = GRAM):
        self.n = min(n, len(of))
        self.grams = grams(of, self.n) if of else set()

    def overlap(self, passage: list[bytes]) -> float:
        return len(self.grams & grams(passage, self.n)) / len(self.grams) if self.grams else 1.0


class _Numbers(dict):
    """Numbers of the words of an index; all other words have the number beyond them."""

    unknown = 0

    def __missing__(self, word: bytes) -> int:
        return self.unknown


class Index:
    """One class of a shard: postings with impacts, sorted by item; greatest impact per word and per block of items."""

    def __init__(self, items: list[tuple], items_in_all: int, mean_length: float, found_in: dict[bytes, int]):
        """``items``: (id, text); ``found_in``: items in all that have the word."""
        self.items = []
        postings: dict[bytes, list[tuple[int, float]]] = {}
        self.window = 2 * LEAST_WIDTH
        parts = [(item_id, *question_and_answer(text)) for item_id, text in items]
        for item_id, question, answer in sorted(parts, key=lambda p: len(p[1]) + len(p[2])):
            own = question + answer
            if not own:
                continue
            weights = {}
            for w in set(own):
                tf, idf = own.count(w), math.log(1 + (items_in_all - found_in[w] + 0.5) / (found_in[w] + 0.5))
                weights[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(own) / mean_length))
            whole = sum(weights.values())
            for w, x in weights.items():
                postings.setdefault(w, []).append((len(self.items), x / whole))
            self.items.append((item_id, Part(question), Part(answer, GRAM if len(answer) > GRAM else 1), Part(own)))
            self.window = max(self.window, 2 * width(len(own)))
        self.numbers = _Numbers((w, i) for i, w in enumerate(postings))
        self.numbers.unknown = len(postings)
        self.postings = list(postings.values())
        self.greatest = np.array([max(x for _, x in p) for p in self.postings] + [0.0])
        self.block_greatest = []
        for p in self.postings:
            best: dict[int, float] = {}
            for item, x in p:
                best[item // BLOCK] = max(best.get(item // BLOCK, 0.0), x)
            self.block_greatest.append(best)
        # The same as a table, a row per word; words and items of a shard are bounded, so is the table.
        self.bounds = np.zeros((len(postings), len(self.items) // BLOCK + 1), np.float32)
        for i, best in enumerate(self.block_greatest):
            self.bounds[i, list(best)] = list(best.values())

    def search(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """Block-max WAND: all items whose impacts over ``terms`` add up to ``least``."""
        lists = [[p[0][0], 0, t, p] for t in set(terms) if (p := self.postings[t])]  # current item, place, word, postings
        out = []

        def forward(entry: list, item: int) -> None:
            place, p = entry[1], entry[3]
            while place < len(p) and p[place][0] < item:
                place += 1
            entry[0], entry[1] = (p[place][0] if place < len(p) else END), place

        while lists:
            lists.sort(key=lambda e: e[0])
            bound, pivot = 0.0, -1
            for i, e in enumerate(lists):
                if e[0] == END:
                    break
                bound += self.greatest[e[2]]
                if bound >= least:
                    pivot = i
                    break
            if pivot < 0:
                return out
            item = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
                pivot += 1
            block = item // BLOCK
            if sum(self.block_greatest[e[2]].get(block, 0.0) for e in lists[: pivot + 1]) < least:
                # No item of this block below the next list's can do.
                beyond = (block + 1) * BLOCK
                if pivot + 1 < len(lists):
                    beyond = min(beyond, lists[pivot + 1][0])
                for e in lists[: pivot + 1]:
                    forward(e, max(beyond, item + 1))
            elif lists[0][0] == item:
                score = sum(e[3][e[1]][1] for e in lists[: pivot + 1])
                if score >= least:
                    out.append((item, score))
                for e in lists[: pivot + 1]:
                    forward(e, item + 1)
            else:
                for e in lists[:pivot]:
                    if e[0] < item:
                        forward(e, item)
        return out

    def passages(self, texts: list[list[bytes]], least: float) -> Iterator[tuple[int, list[bytes], list[int]]]:
        """(text, window, known words) of the windows in which some block can reach ``least``."""
        if not self.postings or not texts:
            return
        step = self.window // 2
        ids = np.fromiter(map(self.numbers.__getitem__, itertools.chain.from_iterable(texts)), np.int64, sum(map(len, texts)))
        offsets = np.cumsum([0, *map(len, texts)])
        of, starts, ends = [], [], []
        for t, words_of in enumerate(texts):
            own = np.arange(0, max(1, len(words_of) - step), step)
            of.append(np.full(len(own), t))
            starts.append(own)
            ends.append(np.minimum(own + self.window, len(words_of)))
        of, starts, ends = map(np.concatenate, (of, starts, ends))
        # So many windows at once that their words times the blocks stay bounded, however long a text is.
        done, total = 0, np.concatenate([[0], np.cumsum(ends - starts)])
        while done < len(of):
            stop = max(done + 1, int(np.searchsorted(total, total[done] + CELLS // self.bounds.shape[1], "right")) - 1)
            for w, terms in self._weighed(ids, offsets[of[done:stop]] + starts[done:stop], (ends - starts)[done:stop], least):
                yield of[done + w], texts[of[done + w]][starts[done + w] : ends[done + w]], terms
            done = stop

    def _weighed(self, ids: np.ndarray, begins: np.ndarray, sizes: np.ndarray, least: float) -> Iterator[tuple[int, list[int]]]:
        """(window, known words) of those in which some block can reach ``least``."""
        unknown = self.numbers.unknown
        window = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begins, sizes)
        codes = np.unique(window * (unknown + 1) + ids[at])
        window, term = codes // (unknown + 1), codes % (unknown + 1)
        window, term = window[term < unknown], term[term < unknown]
        if not len(term):
            return
        begins = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
        # One window alone can be too many words for all blocks: then some blocks at a time.
        bounds, blocks = np.zeros(len(begins), np.float32), max(1, CELLS // len(term))
        for b in range(0, self.bounds.shape[1], blocks):
            bounds = np.maximum(bounds, np.add.reduceat(self.bounds[:, b : b + blocks][term], begins, axis=0).max(axis=1))
        last = np.append(begins[1:], len(window))
        for i in np.flatnonzero(bounds >= least - 1e-4):
            yield window[begins[i]], term[begins[i] : last[i]].tolist()

    def finds(self, texts: list[list[bytes]], least: float, overlap: float) -> list[list[tuple]]:
        """Per text, given as its words, (item id, score, overlap of the question, of the answer): the best passage of each item."""
        best: list[dict[int, tuple]] = [{} for _ in texts]
        for t, passage, terms in self.passages(texts, least):
            for item, score in self.search(terms, least):
                _, question, answer, whole = self.items[item]
                q, a = question.overlap(passage), answer.overlap(passage)
                if (q >= overlap and a >= overlap) or whole.overlap(passage) >= max(overlap, WHOLE_OVERLAP):
                    best[t][item] = max(best[t].get(item, (0.0, 0.0, 0.0)), (min(score, 1.0), q, a))
        return [[(self.items[i][0], *b) for i, b in sorted(found.items())] for found in best]


END = 1 << 60


def finds(shard: list[Index], texts: list[bytes], least: float, overlap: float) -> list[list[tuple]]:
    """``Index.finds`` per text, over all classes of a shard; a text's words are made once."""
    out, group, size = [], [], 0

    def search() -> list[list[tuple]]:
        return [[f for found in own for f in found] for own in zip(*[index.finds(group, least, overlap) for index in shard], strict=True)]

    for text in texts:
        group.append(words(text))
        size += len(group[-1])
        if size >= GROUP_WORDS:
            out += search()
            group, size = [], 0
    return out + search()


def shards(items: DataFrame, item_id: str = "item_id", text: str = "text", most: int = SHARD_WORDS) -> Iterator[list[Index]]:
    """The index, a shard at a time, each a list of its classes; statistics are counted over all items."""
    base = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).filter("text is not null")

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [words(t) for t in common.text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([list(set(w)) for w in own], pa.list_(pa.binary())), pa.array([len(w) for w in own], pa.int64())], ["item_id", "text", "words", "length"])

    split_items, _ = common.store(base.mapInArrow(split, "item_id long, text string, words array<binary>, length long").filter("length > 0"), "benchmark")
    total = split_items.agg(F.count("*").alias("n"), F.sum("length").alias("words"), F.avg("length").alias("mean")).first()
    if not total["n"]:
        return
    parts = math.ceil(total["words"] / (most / 2))
    found_in, _ = common.store(split_items.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")), "benchmark-words")
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for p in range(parts):
        own = split_items.filter(part == p)
        rows = own.select("length", "item_id", "text").orderBy("item_id", "text").collect()
        used = own.select(F.explode("words").alias("word")).distinct()
        counts = {bytes(r["word"]): r["n"] for r in found_in.join(used, "word", "left_semi").collect()}
        classes: dict[int, list[tuple]] = {}
        for length, *item in rows:
            classes.setdefault(width(length), []).append(tuple(item))
        if classes:
            yield [Index(classes[n], total["n"], total["mean"], counts) for n in sorted(classes)]


FOUND = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def find_leaks(docs: DataFrame, items: DataFrame, least: float = LEAST_SCORE, overlap: float = LEAST_OVERLAP, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and test item that it contains."""
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = spark.createDataFrame([], FOUND)
    for shard in shards(items):
        sent = spark.sparkContext.broadcast(pickle.dumps(shard))

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = pickle.loads(sent.value)
            for batch in batches:
                ids = batch.column(0).to_pylist()
                made = [(i, *f) for i, found in zip(ids, finds(own, common.text_bytes(batch.column(1)), least, overlap), strict=True) for f in found]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], k) for i, k in enumerate(kinds)], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        found = found.unionByName(base.mapInArrow(run, FOUND))
    best = F.max(F.struct("score", "question_overlap", "answer_overlap"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def drop_leaks(docs: DataFrame, items: DataFrame, least: float = LEAST_SCORE, overlap: float = LEAST_OVERLAP, text: str = "text") -> DataFrame:
    """``docs`` without the rows that contain a test item; nothing is shuffled."""
    spark, at = docs.sparkSession, docs.columns.index(text)
    for shard in shards(items):
        sent = spark.sparkContext.broadcast(pickle.dumps(shard))

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = pickle.loads(sent.value)
            for batch in batches:
                found = finds(own, common.text_bytes(batch.column(at)), least, overlap)
                yield batch.filter(pa.array([not f for f in found], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
