"""Repeated strings across documents, by prefix doubling over sampled positions.

Wanted: every byte covered by a string of ``LENGTH`` bytes that also starts in a document with a smaller id.
Prefix doubling gives positions the rank of their prefix at growing lengths; a position whose prefix is
unique leaves, the others are ranked again by the pair of their rank and what follows. Ranks need only be
equal or not here, so the rank of a string is its 64-bit name, and Spark brings equal ranks together.

1. At length ``SEED``: of the positions inside each window of ``LENGTH`` bytes only the one with the least
   scrambled rank stands for the window. Equal windows pick equal places, so no repeat is lost, and
   about one position in sixteen remains. The windows of one position are a block.
2. Positions that are unique at ``SEED`` leave. Where all blocks of a rank are equal, those of a larger
   document than the least go as a whole.
3. Where a rank has several different blocks, the pair of rank and name of the whole block ranks them anew: a
   block equal to one of a smaller document goes as a whole.
   In the same round the positions of such blocks are ranked again at ``SEED + REACH``, by their rank and what
   follows, and likewise by what precedes: every window around a position holds the one or the other. A longer
   string that stands in a single document is unique, and the windows that hold it leave.
4. Windows that hold a longer string of several documents are ranked again at ``LENGTH``, by two 64-bit names.

Each batch of documents asks with its distinct ranks only, then with distinct pairs and longer strings, then with
distinct windows (see ``common``). A rank is one row per batch, with its least and greatest document and name, however
many different blocks it has; pairs are dealt by name and windows by their own, so a string that stands in a
third of all documents between different neighbours does not gather either. What the batch itself can
decide it does: the later of two equal blocks goes without asking.

Defined cases: null and empty texts have no bytes; texts shorter than ``LENGTH`` lose nothing; rows that
repeat an id do not remove from each other; a null id counts as larger than all others and two null ids as
equal; overlapping matches count; a character cut by a removed run leaves the rewritten text. Further
columns pass unchanged; where one is named like a result the caller gives the results other ``names``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm import common

LENGTH, SEED = 50, 20
BATCH_BYTES = 8 << 20  # a batch is taken apart into some forty times its bytes
SPAN = LENGTH - SEED + 1  # positions inside a window
REACH = (LENGTH - SEED) // 2  # bytes by which a position is ranked again, on either side
PIECE = 1 << 18
_LOW = np.uint64(PIECE * 2 - 1)
_RNG = np.random.default_rng(20240101)
_BYTES = _RNG.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + _RNG.integers(0, 2, (2, 256), dtype=np.uint64)
_BASE = _RNG.integers(0, 1 << 62, 2, dtype=np.uint64) * np.uint64(4) + np.uint64(1)
LAST = np.iinfo(np.int64).max


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base
    return np.cumprod(out, dtype=np.uint64)


_POWER = [_powers(b, PIECE + 2 * LENGTH) for b in _BASE]
_INVERSE = [_powers(np.uint64(pow(int(b), -1, 1 << 64)), PIECE + 2 * LENGTH) for b in _BASE]


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Blocks:
    """Blocks of a batch: ``lo`` and ``hi`` (first and last window), rank, name, the position ``at`` that stands for
    them, names of the strings of ``SEED + REACH`` bytes that end (``left``) or begin (``right``) with its rank's, and the
    document's place."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.begins = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        valid = np.ones(len(self.data), bool)
        for begin, end in zip(self.begins, self.ends, strict=True):
            valid[max(begin, end - LENGTH + 1) : end] = False
        found = [self._piece(a, valid) for a in range(0, max(0, len(self.data) - LENGTH + 1), PIECE)]
        kinds = (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.uint64, np.uint64)
        columns = zip(*found, strict=True) if found else [[np.empty(0, k)] for k in kinds]
        self.lo, self.hi, self.at, self.rank, self.name, self.left, self.right = [np.concatenate(c) for c in columns]
        self.doc = np.searchsorted(self.ends, self.lo, "right")
        # Equal blocks are a class; classes are numbered by their first block, so by document.
        mixed = scramble(self.rank) + self.name * np.uint64(0x94D049BB133111EB)
        _, first, inverse = np.unique(mixed, return_index=True, return_inverse=True)
        order = np.argsort(first)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.first, self.of = first[order], place[inverse]
        self.ranks, self.rank_of = np.unique(self.rank[self.first], return_inverse=True)

    def asked_ranks(self, ids: np.ndarray) -> dict[str, np.ndarray]:
        """A row per distinct rank: its least document and name, and how far the greatest are beyond (mostly 0)."""
        order = np.argsort(self.rank_of, kind="stable")
        at = np.searchsorted(self.rank_of[order], np.arange(len(self.ranks)))
        out = {"rank": self.ranks}
        for key, of_class in (("doc", ids[self.doc[self.first]]), ("name", self.name[self.first])):
            own = of_class[order]
            out[key] = np.minimum.reduceat(own, at) if len(at) else own
            out[f"{key}_more"] = (np.maximum.reduceat(own, at) if len(at) else own) - out[key]
        return out

    def asked_pairs(self, ids: np.ndarray, classes: np.ndarray) -> dict[str, np.ndarray]:
        """A row per class: its name, rank and least document."""
        first = self.first[classes]
        return {"name": self.name[first], "rank": self.rank[first], "doc": ids[self.doc[first]]}

    def sides(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every class: has it windows that hold its left, and its right, longer string."""
        first = self.first[classes]
        middle = self.at[first] - REACH
        return self.lo[first] <= middle, self.hi[first] >= middle

    def asked_sides(self, ids: np.ndarray, classes: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """A row per distinct longer string, with its least document and how far the greatest is beyond, and
        the row of every left one, then of every right one."""
        first = self.first[classes]
        left, right = self.sides(classes)
        keys, of = np.unique(np.concatenate([self.left[first][left], self.right[first][right]]), return_inverse=True)
        docs = ids[self.doc[np.concatenate([first[left], first[right]])]]
        order = np.argsort(of, kind="stable")
        at = np.searchsorted(of[order], np.arange(len(keys)))
        least = np.minimum.reduceat(docs[order], at) if len(at) else docs
        more = (np.maximum.reduceat(docs[order], at) if len(at) else docs) - least
        return {"side": keys, "side_doc": least, "side_more": more}, of

    def open_windows(self, classes: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every class the windows that hold a shared longer string: how many to skip, and their number. ``shared``:
        the answers to the left strings, then to the right ones."""
        left, right = self.sides(classes)
        n = int(np.count_nonzero(left))
        left[left], right[right] = shared[:n], shared[n:]
        first = self.first[classes]
        lo, hi, middle = self.lo[first], self.hi[first], self.at[first] - REACH
        begin, end = np.where(left, lo, np.maximum(lo, middle)), np.where(right, hi, np.minimum(hi, middle))
        return begin - lo, np.where(left | right, end - begin + 1, 0)

    def _piece(self, a: int, valid: np.ndarray):
        x = self.data[a : a + PIECE + LENGTH - 1]
        n = len(x)
        sums = []
        for k in (0, 1):
            c = np.empty(n + 1, np.uint64)
            c[0] = 0
            np.cumsum(_BYTES[k].take(x) * _POWER[k][:n], out=c[1:])
            sums.append(c)
        rank = scramble((sums[0][SEED:] - sums[0][: n + 1 - SEED]) * _INVERSE[0][: n + 1 - SEED])
        # Least scrambled rank of SPAN neighbours, the leftmost of equal ones: the place sits in the low bits.
        least = (rank & ~_LOW) | np.arange(len(rank), dtype=np.uint64)
        reach = 1
        while reach * 2 <= SPAN:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        rest = SPAN - reach
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        at = np.flatnonzero(valid[a : a + len(least)])
        if not len(at):
            return *[np.empty(0, np.int64)] * 3, *[np.empty(0, np.uint64)] * 4
        stands = (least[at] & _LOW).astype(np.int64)
        new = np.concatenate([[True], (stands[1:] != stands[:-1]) | (at[1:] != at[:-1] + 1)])
        begins = np.flatnonzero(new)
        lo, hi = at[begins], at[np.concatenate([begins[1:], [len(at)]]) - 1]
        name = scramble((sums[1][hi + LENGTH] - sums[1][lo]) * _INVERSE[1][lo] + (hi - lo).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
        seed = stands[begins]

        def longer(begin: np.ndarray, there: np.ndarray) -> np.ndarray:
            names = np.zeros(len(begin), np.uint64)
            b = begin[there]
            names[there] = scramble((sums[1][b + SEED + REACH] - sums[1][b]) * _INVERSE[1][b])
            return names

        left, right = longer(seed - REACH, lo <= seed - REACH), longer(seed, hi >= seed - REACH)
        return lo + a, hi + a, seed + a, rank[seed], name, left, right

    def windows(self, classes: np.ndarray, skip: np.ndarray | None = None, many: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of windows of the first blocks of ``classes``, all or ``many`` after the first ``skip``, and two names of each."""
        lo = self.lo[self.first[classes]] + (0 if skip is None else skip)
        many = self.hi[self.first[classes]] - lo + 1 if many is None else many
        starts = np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum()) if len(classes) else np.empty(0, np.int64)
        names = []
        for k in (0, 1):
            h = np.zeros(len(starts), np.uint64)
            for j in range(LENGTH):
                h = h * _BASE[k] + _BYTES[k].take(self.data[starts + j])
            names.append(scramble(h))
        return starts, names[0], names[1]


def _read(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def _write(rows: pa.Table, doc_id: str) -> bytes:
    """A batch's rows in order of id, as one compressed message."""
    rows = rows.sort_by([(doc_id, "ascending")])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(rows.combine_chunks())
    return sink.getvalue().to_pybytes()


def _ids(rows: pa.Table, doc_id: str) -> np.ndarray:
    return rows.column(doc_id).cast(pa.int64()).fill_null(LAST).to_numpy()


def _texts(rows: pa.Table, text: str) -> list[bytes]:
    return common.text_bytes(rows.column(text).combine_chunks())


def _split(batches: list[int], parts: list[np.ndarray], values: dict[str, np.ndarray]):
    """Answers per batch, cut from arrays over all batches."""
    edges = np.cumsum([0, *map(len, parts)])
    return [(b, {n: v[edges[i] : edges[i + 1]] for n, v in values.items()}) for i, b in enumerate(batches)]


def _groups(*keys: np.ndarray) -> np.ndarray:
    """True where a new group begins in sorted ``keys``."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


BEFORE, SEVERAL = 1, 2


def _answer_ranks(bucket: int, batches: list[int], asked: list[dict[str, np.ndarray]]) -> list[tuple]:
    """Per rank: has it several names and documents; else, is there a smaller document than the batch's."""
    rank, doc, doc_more, name, name_more = [np.concatenate([q[k] for q in asked]) for k in ("rank", "doc", "doc_more", "name", "name_more")]
    order = np.argsort(rank, kind="stable")
    new = _groups(rank[order])
    at, group = np.flatnonzero(new), np.cumsum(new) - 1
    least, names = np.minimum.reduceat(doc[order], at), np.minimum.reduceat(name[order], at)
    one_doc = np.maximum.reduceat((doc + doc_more)[order], at) == least
    one_name = np.maximum.reduceat((name + name_more)[order], at) == names
    flags = np.empty(len(rank), np.uint8)
    flags[order] = np.where((one_doc | one_name)[group], np.where(one_name[group] & (least[group] < doc[order]), BEFORE, 0), SEVERAL)
    return [(b, bucket, common.frame(**a)) for b, a in _split(batches, [q["rank"] for q in asked], {"flag": flags})]


def _answer_pairs(bucket: int, batches: list[int], asked: list[dict[str, np.ndarray]]) -> list[tuple]:
    """Per block: is there an equal one in a smaller document. Per longer string: is it in several documents."""
    side, doc, more = [np.concatenate([q[k] for q in asked]) for k in ("side", "side_doc", "side_more")]
    order = np.argsort(side, kind="stable")
    new = _groups(side[order])
    at = np.flatnonzero(new)
    shared = np.zeros(len(side), np.uint8)
    if len(at):
        several = np.maximum.reduceat((doc + more)[order], at) > np.minimum.reduceat(doc[order], at)
        shared[order] = several[np.cumsum(new) - 1]
    flags = _split(batches, [q["name"] for q in asked], {"flag": _earlier(asked, "name", "rank")})
    sides = _split(batches, [q["side"] for q in asked], {"shared": shared})
    return [(b, bucket, common.frame(**f, **s)) for (b, f), (_, s) in zip(flags, sides, strict=True)]


def _answer_windows(bucket: int, batches: list[int], asked: list[dict[str, np.ndarray]]) -> list[tuple]:
    """Per window: does an equal one start in a smaller document."""
    flags = _earlier(asked, "one", "two")
    return [(b, bucket, common.frame(**a)) for b, a in _split(batches, [q["one"] for q in asked], {"flag": flags})]


def _earlier(asked: list[dict[str, np.ndarray]], key: str, other: str) -> np.ndarray:
    """Is there the same pair in a smaller document."""
    one, two, doc = [np.concatenate([q[k] for q in asked]) for k in (key, other, "doc")]
    order = np.lexsort((doc, two, one))
    d = doc[order]
    new = _groups(one[order], two[order])
    flags = np.zeros(len(one), np.uint8)
    flags[order] = d[np.flatnonzero(new)][np.cumsum(new) - 1] < d
    return flags


def _distinct_windows(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window of each kind, in order, and the kind of every window."""
    mixed = one + two * np.uint64(0x94D049BB133111EB)
    _, first, inverse = np.unique(mixed, return_index=True, return_inverse=True)
    order = np.argsort(first)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return first[order], place[inverse]


def _removed(blocks: Blocks, ids: np.ndarray, flags: np.ndarray, skip: np.ndarray, many: np.ndarray, window_flags) -> np.ndarray:
    """True for every removed byte of a batch. Of every class the ``many`` windows after the first ``skip`` are open;
    ``window_flags(one, two, doc)`` answers for distinct ones."""
    edge = np.zeros(len(blocks.data) + LENGTH + 1, np.int32)
    doc = ids[blocks.doc]
    first = doc[blocks.first]
    goes = (doc > first[blocks.of]) | (flags[blocks.of] == BEFORE)
    edge[blocks.lo[goes]] += 1
    edge[blocks.hi[goes] + LENGTH] -= 1
    classes = np.flatnonzero(many)
    if len(classes):
        starts, one, two = blocks.windows(classes, skip[classes], many[classes])
        where, kind = _distinct_windows(one, two)
        of_window = np.repeat(first[classes], many[classes])
        known = window_flags(one[where], two[where], of_window[where]).astype(bool)
        out = known[kind] | (of_window[where][kind] < of_window)
        # The same block again in the same document loses the same windows.
        begins = np.zeros(len(blocks.first), np.int64)
        begins[classes] = np.cumsum(many[classes]) - many[classes]
        more = np.flatnonzero((many[blocks.of] > 0) & ~goes)
        lengths = many[blocks.of[more]]
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        hit = out[np.repeat(begins[blocks.of[more]], lengths) + inside]
        gone = (np.repeat(blocks.lo[more] + skip[blocks.of[more]], lengths) + inside)[hit]
        edge[gone] += 1
        edge[gone + LENGTH] -= 1
    return np.cumsum(edge, out=edge)[: len(blocks.data)] > 0


RESULT_NAMES = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
_ASKED = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary())])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", names: list[str] = RESULT_NAMES) -> DataFrame:
    """``docs`` with the text that is left, and n_bytes, n_removed, n_spans, kept_sha256 (or ``names``)."""
    spark = docs.sparkSession
    batches, _ = common.store(common.text_batches(docs, text, lambda rows: _write(rows, doc_id), BATCH_BYTES), "suffix-batches")
    buckets = common.bucket_count(batches)

    def ask_ranks(batch: int, blob: bytes) -> list[tuple]:
        rows = _read(blob)
        return common.questions(batch, Blocks(_texts(rows, text)).asked_ranks(_ids(rows, doc_id)), "rank", buckets)

    first, _ = common.store(common.answer_each(common.ask_each(batches, ask_ranks), _answer_ranks, common.ASK_SCHEMA, _ASKED), "suffix-ranks")

    def several(blocks: Blocks, answers: dict) -> tuple[np.ndarray, np.ndarray]:
        """Flags of all classes by their ranks alone, and the classes that ask by pair."""
        flags = common.answered(blocks.ranks, buckets, answers, {"flag": np.uint8})["flag"][blocks.rank_of]
        return flags, np.flatnonzero(flags == SEVERAL)

    def left_open(blocks: Blocks, ids: np.ndarray, answers: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flags of all classes, and the windows that are open: how many to skip, and their number."""
        flags, classes = several(blocks, answers)
        before = common.answered(blocks.name[blocks.first[classes]], buckets, answers, {"flag": np.uint8}, buckets)["flag"]
        flags[classes] = np.where(before, BEFORE, SEVERAL)
        sides, of = blocks.asked_sides(ids, classes)
        shared = common.answered(sides["side"], buckets, answers, {"shared": np.uint8}, buckets)["shared"].astype(bool)
        skip, many = np.zeros(len(flags), np.int64), np.zeros(len(flags), np.int64)
        skip[classes], many[classes] = blocks.open_windows(classes, shared[of])
        many[flags != SEVERAL] = 0
        return flags, skip, many

    def ask_pairs(batch: int, blob: bytes, answers: dict) -> pa.Table:
        rows = _read(blob)
        blocks, ids = Blocks(_texts(rows, text)), _ids(rows, doc_id)
        classes = several(blocks, answers)[1]
        return common.rows(common.questions_of(batch, [("name", blocks.asked_pairs(ids, classes)), ("side", blocks.asked_sides(ids, classes)[0])], buckets), _ASKED)

    def ask_windows(batch: int, blob: bytes, answers: dict) -> pa.Table:
        rows = _read(blob)
        blocks, ids = Blocks(_texts(rows, text)), _ids(rows, doc_id)
        _, skip, many = left_open(blocks, ids, answers)
        classes = np.flatnonzero(many)
        starts, one, two = blocks.windows(classes, skip[classes], many[classes])
        where, _ = _distinct_windows(one, two)
        doc = ids[np.searchsorted(blocks.ends, starts[where], "right")]
        return common.rows(common.questions(batch, {"one": one[where], "two": two[where], "doc": doc}, "one", buckets), _ASKED)

    def answers_to(ask, known: DataFrame, answer, name: str, rounds: int) -> DataFrame:
        asked = common.with_answers(batches, known, ask, common.ASK_SCHEMA)
        made, _ = common.store(common.answer_each(asked, answer, common.ASK_SCHEMA, _ASKED), name)
        return known.unionByName(made.withColumn("bucket", (F.col("bucket") + rounds * buckets).cast("int")))

    # Only what the answers before leave open is asked again; their flags are needed in the end too.
    two_rounds = answers_to(ask_pairs, first, _answer_pairs, "suffix-pairs", 1)
    all_rounds = answers_to(ask_windows, two_rounds, _answer_windows, "suffix-windows", 2)

    def finish(batch: int, blob: bytes, answers: dict) -> pa.Table:
        rows = _read(blob)
        texts, ids = _texts(rows, text), _ids(rows, doc_id)
        blocks = Blocks(texts)

        def window_flags(one, two, doc):
            return common.answered(one, buckets, answers, {"flag": np.uint8}, 2 * buckets)["flag"]

        gone = _removed(blocks, ids, *left_open(blocks, ids, answers), window_flags)
        left, counts = [], []
        for whole, begin, end in zip(texts, blocks.begins, blocks.ends, strict=True):
            mask = gone[begin:end]
            n = int(np.count_nonzero(mask))
            spans = int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(mask[0]) if n else 0
            rest = blocks.data[begin:end][~mask].tobytes() if n else whole
            counts.append((len(whole), n, spans, hashlib.sha256(rest).hexdigest()))
            left.append(rest.decode(errors="ignore") if n else None)
        old = rows.column(text).to_pylist()
        new = pa.array([o if x is None else x for x, o in zip(left, old, strict=True)], rows.schema.field(text).type)
        made = rows.set_column(rows.schema.get_field_index(text), rows.schema.field(text), new)
        for i, (name, kind) in enumerate(zip(names, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)):
            made = made.append_column(name, pa.array([c[i] for c in counts], kind))
        return made

    schema = docs.select("*", *[F.lit(None).cast(kind).alias(n) for n, kind in zip(names, ("long", "long", "long", "string"), strict=True)]).schema
    return common.with_answers(batches, all_rounds, finish, schema)
