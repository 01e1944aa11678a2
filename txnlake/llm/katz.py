"""Katz backoff language model of words, learnt and applied in Spark.

Tokens of a text: its words, A-Z in lower case, then one end. The model has n-grams of one and two words:

    P(w | h) = d(r) r / c(h)   if the pair (h, w) was seen r times
             = alpha(h) P(w)   if not, or P(w) where h itself was never seen
    P(w)     = d1(r) r / N     if w was seen r times
             = the mass that is left, for all unseen words together

``d`` discounts counts up to ``CUTOFF`` by Good-Turing; where the counts of counts do not allow it, by
an absolute discount. ``alpha(h) = (1 - sum of seen P(w|h)) / (1 - sum of their P(w))`` exactly, so
the words seen and the unseen word sum to one after every history. A history whose counts are all above the
cutoff would leave nothing; it is given one count more than it has, and what that leaves.

Nothing of the corpus reaches the driver but counts of counts. Texts become batches of word numbers (stored); a
batch asks once for each word and pair it has, with how often its training texts have it. Buckets of keys
add the counts up, store them as the count tables, and answer; each seen pair is given to one batch, which
adds its share to the history's sums; buckets of histories answer with the weights; then each batch scores
its texts. Words and pairs have 64-bit names.

Defined cases: null and empty texts are one end token; a null id is learnt from and is not held out;
repeated rows each count and each give a row; without training texts N is 0 and every token is the unseen word
with probability 1; tables without rows give none.
"""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm import common

CUTOFF = 5
# A space cannot be part of a word.
END_KEY, START_KEY = xxhash.xxh64_intdigest(b" end"), xxhash.xxh64_intdigest(b" start")
END, START = 0, 1  # numbers in every batch


def words(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: exactly A-Z, and white space 20 09-0D


def encode(rows: pa.Table) -> bytes:
    """A batch (doc_id, text, train): word numbers of all texts and the names of the batch's words."""
    numbers: dict[bytes, int] = defaultdict(itertools.count(2).__next__)
    tokens, counts = [], []
    for text in common.text_bytes(rows.column(1).combine_chunks()):
        own = list(map(numbers.__getitem__, words(text)))
        own.append(END)
        tokens.append(np.array(own, np.uint32))
        counts.append(len(own))
    keys = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
    ids = rows.column(0).cast(pa.int64())
    return common.frame(
        doc=ids.fill_null(0).to_numpy(),
        known=ids.is_valid().to_numpy(),
        train=rows.column(2).to_numpy(),
        count=np.array(counts, np.int64),
        token=np.concatenate(tokens),
        key=np.concatenate([np.array([END_KEY, START_KEY], np.uint64), keys]),
    )


class Batch:
    """A batch with its pairs: ``pair`` numbers of (history, word) per token, ``history`` and ``word`` per pair."""

    def __init__(self, blob: bytes):
        a = common.unframe(blob)
        self.doc, self.known, self.train, self.count, self.token, self.key = (a[k] for k in ("doc", "known", "train", "count", "token", "key"))
        self.begins = np.cumsum(self.count) - self.count
        before = np.empty(len(self.token), np.uint64)
        before[1:] = self.token[:-1]
        before[self.begins] = START
        codes, self.pair = np.unique((before << np.uint64(32)) | self.token, return_inverse=True)
        self.history, self.word = (codes >> np.uint64(32)).astype(np.int64), (codes & np.uint64(0xFFFFFFFF)).astype(np.int64)

    def pair_keys(self) -> np.ndarray:
        h = self.key[self.history] * np.uint64(0x9E3779B97F4A7C15) + (self.key[self.word] ^ np.uint64(0xD1B54A32D192ED03)) * np.uint64(0x2545F4914F6CDD1D)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))

    def training(self, of: np.ndarray, n: int) -> np.ndarray:
        """How often each of ``n`` numbers stands in the batch's training texts."""
        return np.bincount(of[np.repeat(self.train, self.count)], minlength=n).astype(np.uint32)


_COUNTED = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary()), ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("stats", pa.list_(pa.int64()))])
COUNTED = "batch long, bucket int, payload binary, keys array<long>, counts array<long>, stats array<long>"


def _count(bucket: int, batches: list[int], asked: list[dict[str, np.ndarray]]) -> list[tuple]:
    """Add up a bucket: answers to the batches, and one row of the count table (its batch is null)."""
    keys, n = (np.concatenate([q[k] for q in asked]) for k in ("key", "n"))
    order = np.lexsort((n == 0, keys))
    new = np.ones(len(keys), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    at = np.flatnonzero(new)
    total = np.add.reduceat(n[order].astype(np.int64), at)
    # The first batch that has it in training answers for a key.
    code = total[np.cumsum(new) - 1] * 2
    code[at] += total > 0
    out = np.empty(len(keys), np.int64)
    out[order] = code
    edges = np.cumsum([0, *[len(q["key"]) for q in asked]])
    made = [(b, bucket, common.frame(code=out[edges[i] : edges[i + 1]]), None, None, None) for i, b in enumerate(batches)]
    seen = total > 0
    of_counts = np.bincount(np.minimum(total[seen], CUTOFF + 2), minlength=CUTOFF + 3)[1 : CUTOFF + 2]
    stats = [int(total.sum()), int(seen.sum()), *map(int, of_counts)]
    return [*made, (None, bucket, None, keys[order][at][seen].view(np.int64), total[seen], stats)]


class Discount:
    """Factors by count, and what a unigram model leaves to the unseen word."""

    def __init__(self, total: int, of_counts: list[int]):
        n = [0, *of_counts]  # n[r]: how many n-grams were seen r times, r up to CUTOFF + 1
        factors = np.ones(CUTOFF + 1)
        usable = n[1] > 0 and all(n[r] > 0 for r in range(1, CUTOFF + 2))
        if usable:
            common_part = (CUTOFF + 1) * n[CUTOFF + 1] / n[1]
            if common_part < 1:
                factors[1:] = [((r + 1) * n[r + 1] / (n[r] * r) - common_part) / (1 - common_part) for r in range(1, CUTOFF + 1)]
        if not usable or not all(0 < f <= 1 for f in factors[1:]) or factors[1:].min() == 1:
            less = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
            factors[1:] = [(r - less) / r if less < 1 else 0.5 / r for r in range(1, CUTOFF + 1)]
        self.factors = np.concatenate([factors, [1.0]])
        left = sum(n[r] * r * (1 - factors[r]) for r in range(1, CUTOFF + 1)) / total if total else 1.0
        # Without any count up to the cutoff nothing is left: one count more than there is.
        self.total, self.left = (total, left) if left > 0 else (total + 1, 1 / (total + 1))

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return counts * self.factors[np.minimum(counts, CUTOFF + 1)]

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self(counts) / max(self.total, 1), self.left)


def _weigh(bucket: int, batches: list[int], asked: list[dict[str, np.ndarray]]) -> list[tuple]:
    """Backoff weights of a bucket's histories; minus the unseen words' mass where the seen ones leave nothing."""
    keys, lower, higher = (np.concatenate([q[k] for q in asked]) for k in ("key", "lower", "higher"))
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    at = np.flatnonzero(new)
    left, unseen = 1 - np.add.reduceat(higher[order], at), 1 - np.add.reduceat(lower[order], at)
    weight = np.where(left > 1e-9, left / np.maximum(unseen, 1e-300), -unseen)
    out = np.empty(len(keys))
    out[order] = weight[np.cumsum(new) - 1]
    edges = np.cumsum([0, *[len(q["key"]) for q in asked]])
    return [(b, bucket, common.frame(weight=out[edges[i] : edges[i + 1]])) for i, b in enumerate(batches)]


_SCORED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


class Model:
    """What is left of learning: batches, their counts, the weights of histories, and the two discounts."""

    def __init__(self, docs: DataFrame, train: str = "train", doc_id: str = "doc_id", text: str = "text"):
        """``train``: a boolean column, true for texts to learn from (null: not)."""
        chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.col(train), F.lit(False)).alias("train"))
        self.batches, _ = common.store(common.text_batches(chosen, "text", encode), "katz-batches")
        self.buckets = buckets = common.bucket_count(self.batches)

        def ask_counts(batch: int, blob: bytes) -> list[tuple]:
            b = Batch(blob)
            single = {"key": b.key, "n": b.training(b.token, len(b.key))}
            double = {"key": b.pair_keys(), "n": b.training(b.pair, len(b.history))}
            return common.questions(batch, single, "key", buckets) + common.questions(batch, double, "key", buckets, buckets)

        asked = common.ask_each(self.batches, ask_counts)
        counted, _ = common.store(common.answer_each(asked, _count, COUNTED, _COUNTED), "katz-counts")
        self.answers = counted.filter("batch is not null").select("batch", "bucket", "payload")
        self.table = counted.filter("batch is null").select((F.col("bucket") >= buckets).alias("pair"), "bucket", "keys", "counts", "stats")
        sums = [F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(CUTOFF + 3)]
        stats = {r["pair"]: [r[f"s{i}"] or 0 for i in range(CUTOFF + 3)] for r in self.table.groupBy("pair").agg(*sums).collect()}
        (self.tokens, self.types, *ones), (pairs, _, *twos) = (stats.get(k, [0] * (CUTOFF + 3)) for k in (False, True))
        self.one, self.two = Discount(self.tokens, ones), Discount(pairs, twos)
        first, second = self.one, self.two

        def ask_weights(batch: int, blob: bytes, answers: dict) -> pa.Table:
            b = Batch(blob)
            words, pairs, own = _counts(b, buckets, answers)
            lower, higher = np.zeros(len(b.key)), np.zeros(len(b.key))
            h = b.history[own]
            np.add.at(lower, h, first.unigram(words[b.word[own]]))
            np.add.at(higher, h, second(pairs[own]) / np.maximum(_histories(words)[h], 1))
            wanted = _wanted(b, words)
            return common.rows(common.questions(batch, {"key": b.key[wanted], "lower": lower[wanted], "higher": higher[wanted]}, "key", buckets), common.ASK)

        asked = common.with_answers(self.batches, self.answers, ask_weights, common.ASK_SCHEMA)
        self.weights, _ = common.store(common.answer_each(asked, _weigh, common.ASK_SCHEMA, common.ASK), "katz-weights")

    def scores(self) -> DataFrame:
        """doc_id, n_tokens, n_known, base_score, score of every text, learnt from or not."""
        buckets, first, second, total, types = self.buckets, self.one, self.two, self.tokens, self.types
        both = self.answers.unionByName(self.weights.withColumn("bucket", (F.col("bucket") + 2 * buckets).cast("int")))

        def score(batch: int, blob: bytes, answers: dict) -> pa.Table:
            b = Batch(blob)
            words, pairs, _ = _counts(b, buckets, answers)
            wanted = _wanted(b, words)
            weight = np.zeros(len(b.key))
            weight[wanted] = common.answered(b.key[wanted], buckets, answers, {"weight": np.float64}, 2 * buckets)["weight"]
            p = pair_probability(first, second, words, pairs, b.history, b.word, weight)
            logs = np.log10(p)[b.pair]
            known = words[b.token] > 0
            base = np.log10((words[b.token] + 0.5) / (total + 0.5 * (types + 1)))
            sums = [np.add.reduceat(x, b.begins) for x in (known.astype(np.int64), base, logs)]
            ids = pa.array(b.doc, mask=~b.known)
            return pa.Table.from_arrays([ids, pa.array(b.count), pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[2])], schema=_SCORED)

        return common.with_answers(self.batches, both, score, SCORED)


def _counts(b: Batch, buckets: int, answers: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of the batch's words and pairs, and the pairs it answers for."""
    one = common.answered(b.key, buckets, answers, {"code": np.int64})["code"]
    two = common.answered(b.pair_keys(), buckets, answers, {"code": np.int64}, buckets)["code"]
    one[START] = 0
    return one >> 1, two >> 1, np.flatnonzero(two & 1)


def _histories(words: np.ndarray) -> np.ndarray:
    """How often each word is a history: as often as it occurs; a text starts as often as one ends."""
    out = words.copy()
    out[START] = words[END]
    return out


def _wanted(b: Batch, words: np.ndarray) -> np.ndarray:
    """The batch's histories that training has."""
    used = np.zeros(len(b.key), bool)
    used[b.history] = True
    return np.flatnonzero(used & (_histories(words) > 0))


def pair_probability(one: Discount, two: Discount, words, pairs, history, word, weight) -> np.ndarray:
    """The recursion: a discounted count, else the history's weight times the shorter n-gram."""
    c, single, alpha = _histories(words)[history], one.unigram(words[word]), weight[history]
    full = alpha < 0  # the seen words leave nothing: one count more
    seen = np.where(full, pairs / (c + 1.0), two(pairs) / np.maximum(c, 1))
    unseen = np.where(full, 1 / (c + 1.0) / np.maximum(-alpha, 1e-300), alpha) * single
    return np.where(c == 0, single, np.where(pairs > 0, seen, unseen))
