"""Near-duplicates by MinHash bands and odd sketches.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; a document's set is its distinct shingles of
``SHINGLE`` words, with fewer words the whole sequence as one.

* ``BANDS * ROWS`` MinHash values give bands, the keys of buckets: at a similarity of 0.8 two sets share no
  bucket with probability (1 - 0.8^4)^40 < 1e-9.
* ``BINS`` further MinHash samples (the least name in each bin of the names) are folded into an odd sketch, a
  bitmap in which every sample flips one bit. Of two sketches the population count of their XOR
  estimates how many samples differ, d = -n/2 ln(1 - 2x/n) with n bits, x of them odd, and so, precisely where it
  is high, the similarity: a bin whose least name only one set has differs once, or twice where the other
  set has a name there too, which it does in the share of bins it fills. Candidates whose estimate is ``MARGIN``
  below the threshold, seven standard deviations where all bins are full, go without a look at their texts.

Equal sets are a class from the start, and only its smallest id goes on. In every bucket a leader (the member
with the least hash, of ``LEADS`` kinds by band) meets all others; candidates that pass are confirmed on full sets;
components follow. A bucket whose members are in one component is settled. In the others, each member outside
the bucket's largest component meets all members of other components: both sides are cut into blocks, a task takes
one block of each and compares sketches; what passes is compared in the first bucket the two share: in one round only
the likeliest of each member, in a second all that are then still apart. Pairs are not rows: a member carries its
partners, the full sets of a block's members come to it once each, and it gives out a forest, the links that join
components still apart. Rows grow with the members of open buckets (times blocks of ``MEMBERS`` in a bucket); the
comparisons within a block are those of its members. A pair is left out only where its two are known to be
connected or its sketches rule it out; no bucket is one task, nothing is capped.

Defined cases: null and empty texts and those of white space have an empty set, n_shingles 0, no links;
rows that repeat an id are judged each by its own text, and where these differ the smallest text
stands for the id against unequal ones; a null id has no links and no component, and is kept; other
columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm import common
from txnlake.llm.components import components

SHINGLE, BANDS, ROWS = 5, 40, 4
BINS, SKETCH_WORDS = 1024, 32  # samples of a sketch; its words of 64 bits
MARGIN = 0.08
LEADS = 4
OUTSIDERS, MEMBERS = 1024, 2048  # rows of a block on either side
PART_SHINGLES = 2_000_000  # names of shingles that are compared together
WORDS_KEPT = 500_000  # names of words a worker remembers
_RNG = np.random.default_rng(5)
_PLACE = _RNG.integers(0, 1 << 62, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = _RNG.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_BAND = _RNG.integers(0, 1 << 62, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Names(dict):
    def __missing__(self, word: bytes) -> int:
        name = self[word] = xxhash.xxh64_intdigest(word)
        return name


_names = _Names()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingles(text: bytes) -> np.ndarray:
    """Sorted 64-bit names of the distinct shingles."""
    words = text.lower().split()  # of bytes: exactly A-Z, and white space 20 09-0D
    if len(_names) > WORDS_KEPT:
        _names.clear()
    names = np.fromiter(map(_names.__getitem__, words), np.uint64, len(words))
    if len(names) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b"short " + b" ".join(words))], np.uint64) if len(names) else np.empty(0, np.uint64)
    n = len(names) - SHINGLE + 1
    h = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        h += _mix(names[k : k + n] + _PLACE[k]) * _PLACE[k]
    return np.unique(_mix(h))


def minhash(names: np.ndarray) -> np.ndarray:
    """Least value of every hash function; 32 bits, which numpy multiplies several at a time."""
    short = (names >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(_FACTOR), np.iinfo(np.uint32).max, np.uint32)
    for a in range(0, len(short), 256):
        np.minimum(best, ((short[a : a + 256, None] + _ADD) * _FACTOR).min(axis=0), out=best)
    return best


def band_keys(values: np.ndarray) -> np.ndarray:
    wide = _mix(values.astype(np.uint64) + np.arange(len(values), dtype=np.uint64) * np.uint64(1 << 32))
    return _mix((wide.reshape(BANDS, ROWS) * _BAND).sum(axis=1, dtype=np.uint64))


def odd_sketch(names: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of samples, and the bitmap in which each flips one bit. ``names`` are sorted and distinct."""
    scattered = np.sort(_mix(names))
    bins = scattered >> np.uint64(64 - BINS.bit_length() + 1)
    least = scattered[np.concatenate([[True], bins[1:] != bins[:-1]])] if len(names) else scattered
    bit = (_mix(least) % np.uint64(64 * SKETCH_WORDS)).astype(np.int64)
    odd = np.bincount(bit, minlength=64 * SKETCH_WORDS) % 2 == 1
    return len(least), np.packbits(odd).view(np.uint64)


def estimate(a_samples, b_samples, odd_bits):
    """Estimated similarity of numpy values; -1 where the sketches have nothing in common."""
    n = 64.0 * SKETCH_WORDS
    differ = -n / 2 * np.log(np.maximum(1 - 2 * odd_bits / n, 1e-9))
    both = (a_samples + b_samples - differ) / 2
    full = 1 + np.maximum(a_samples, b_samples) / BINS
    return np.where(both > 0, both / np.maximum(both + differ / full, 1e-9), -1.0)


SIGNED = "doc_id long, n_shingles long, digest string, bands array<long>, samples int, sketch array<long>, text_hash long"


def text_hash(text: str = "text"):
    """Tells rows of one id with different texts apart."""
    return F.xxhash64(text).alias("text_hash")


def sign(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, size of the set, digest of the set (null for an empty one), band keys, sketch, hash of the text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for data in common.text_bytes(batch.column(1)):
                names = shingles(data)
                if len(names):
                    samples, sketch = odd_sketch(names)
                    made.append((len(names), hashlib.blake2b(names.tobytes(), digest_size=16).hexdigest(), band_keys(minhash(names)).view(np.int64), samples, sketch.view(np.int64)))
                else:
                    made.append((0, None, None, None, None))
            kinds = (pa.int64(), pa.string(), pa.list_(pa.int64()), pa.int32(), pa.list_(pa.int64()))
            columns = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, batch.column(2)], ["doc_id", "n_shingles", "digest", "bands", "samples", "sketch", "text_hash"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), text_hash(text)).mapInArrow(run, SIGNED)


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirm(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """Of candidate ``pairs`` (a, b) those whose full sets are alike."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("__id")).distinct()
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(wanted, F.col("id") == F.col("__id"), "left_semi")
    texts, path = common.store(texts.groupBy("id").agg(F.min("text").alias("text")), "near-texts")
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, names = None, np.empty(0, np.uint64)
        for batch in batches:
            one, two, good = common.text_bytes(batch.column(2)), common.text_bytes(batch.column(3)), []
            for i, a in enumerate(batch.column(0).to_pylist()):
                if a != last:  # a leader's pairs mostly follow one another
                    last, names = a, shingles(one[i])
                good.append(alike(names, shingles(two[i]), percent))
            kept = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))
            yield kept

    return both.mapInArrow(run, "a long, b long")


def candidates(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose odd sketches do not rule them out: ``estimate`` in column functions."""
    one, two = (classes.select(F.col("id").alias(x), F.col("samples").alias(f"{x}_n"), F.col("sketch").alias(f"{x}_sketch")) for x in "ab")
    odd = sum((F.bit_count(F.col("a_sketch")[i].bitwiseXOR(F.col("b_sketch")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    n = 64.0 * SKETCH_WORDS
    differ = F.log(F.greatest(1 - 2 * odd / F.lit(n), F.lit(1e-9))) * F.lit(-n / 2)
    full = 1 + F.greatest("a_n", "b_n") / F.lit(float(BINS))
    shared = (F.col("a_n") + F.col("b_n") - F.col("d")) / 2
    both = pairs.distinct().join(one, "a").join(two, "b").select("a", "b", "a_n", "b_n", differ.alias("d"))
    return both.filter((shared > 0) & (shared >= F.lit(percent / 100 - MARGIN) * (shared + F.col("d") / full))).select("a", "b")


ASKED = "key long, x long, y long, part long, id long, root long, partners array<long>"


def between_components(placed: DataFrame, classes: DataFrame, percent: int, likeliest: bool) -> DataFrame:
    """Who is to be compared in open buckets: members of different components whose sketches allow a link.

    ``placed``: key, id, root, main (root of the bucket's largest component). Returns a row per block and member
    that has candidates there: those that ask carry their ``partners``, the likeliest first; ``part`` keeps what is
    compared together below ``PART_SHINGLES``. ``likeliest``: of each member outside the largest component only the
    likeliest candidate inside and the likeliest other, per pair of blocks.
    """
    out = F.col("root") != F.col("main")
    sizes = placed.groupBy("key").agg(F.ceil(F.count_if(out) / OUTSIDERS).alias("outs"), F.ceil(F.count("*") / MEMBERS).alias("alls"))
    full = placed.join(sizes.withColumnRenamed("key", "of"), F.col("key") == F.col("of")).drop("of")
    full = full.join(classes.select(F.col("id").alias("of"), "n_shingles", "samples", "bands", "sketch"), F.col("id") == F.col("of")).drop("of")
    fields = ["id", "root", "main", "n_shingles", "samples", "bands", "sketch"]
    spread = F.xxhash64("id", F.lit(3))
    left = full.filter(out).select("key", F.pmod(spread, "outs").alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("alls") - 1)).alias("y"), F.lit(True).alias("outside"), *fields)
    right = full.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("outs") - 1)).alias("x"), F.pmod(spread, "alls").alias("y"), F.lit(False).alias("outside"), *fields)
    least = percent / 100 - MARGIN

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        own = np.int64(key[0].as_py()).view(np.uint64)
        outside = rows.column("outside").to_numpy()
        ids, roots, mains, sizes, samples = (rows.column(c).to_numpy() for c in ("id", "root", "main", "n_shingles", "samples"))
        bands, sketches = (rows.column(c).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(rows), -1) for c in ("bands", "sketch"))
        at, others = np.flatnonzero(outside), np.flatnonzero(~outside)
        asks = []
        for i in at:
            j = others[roots[others] != roots[i]]
            # Of two outsiders the one with the smaller id asks.
            j = j[(roots[j] == mains[j]) | (ids[j] > ids[i])]
            odd = np.bitwise_count(sketches[j] ^ sketches[i]).sum(axis=1)
            score = estimate(samples[i], samples[j], odd)
            j, score = j[score >= least], score[score >= least]
            if len(j):
                first = bands[i][(bands[j] == bands[i]).argmax(axis=1)] == own
                j, score = j[first], score[first]
                if likeliest:
                    inside = roots[j] == mains[j]
                    j = np.array([j[x][score[x].argmax()] for x in (inside, ~inside) if x.any()], np.int64)
                else:
                    j = j[np.lexsort((ids[j], -score))]
                if len(j):
                    asks.append((i, j))
        made = [(part, i, roots[at], partners.get(i)) for part, (held, partners) in enumerate(_parts(asks, ids, sizes)) for i, at in held.items()]
        columns = [[k.as_py()] * len(made) for k in key] + [[m[c] for m in made] for c in range(4)]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.list_(pa.int64()))], ["key", "x", "y", "part", "id", "root", "partners"])

    return left.unionByName(right).groupBy("key", "x", "y").applyInArrow(run, ASKED)


def _parts(asks: list, ids: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[dict, dict]]:
    """Members (id to place) and partners (id to ids) of parts whose sets have ``PART_SHINGLES`` or are of one pair."""
    held, partners, size = {}, {}, 0
    for i, found in asks:
        for j in found:
            more = sum(int(sizes[m]) for m in (i, j) if ids[m] not in held)
            if held and size + more > PART_SHINGLES:
                yield held, partners
                held, partners, size, more = {}, {}, 0, int(sizes[i]) + int(sizes[j])
            held[ids[i]], held[ids[j]] = i, j
            size += more
            partners.setdefault(ids[i], []).append(ids[j])
    if held:
        yield held, partners


def sets_of(wanted: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(of, names): the full sets of the ids in ``wanted``."""
    wanted = wanted.select(F.col("id").alias("__id")).distinct()
    texts = docs.select(F.col(doc_id).cast("long").alias("of"), F.col(text).alias("text")).join(wanted, F.col("of") == F.col("__id"), "left_semi")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = pa.array([shingles(data).tobytes() for data in common.text_bytes(batch.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), names], ["of", "names"])

    return texts.groupBy("of").agg(F.min("text").alias("text")).mapInArrow(run, "of long, names binary")


def spanning_links(asked: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) confirmed on full sets, within the blocks: of each part a forest that joins the components it
    finds linked, so at most one link less than it has members. A pair that links before have joined is not compared."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        ids, roots = rows.column("id").to_pylist(), rows.column("root").to_pylist()
        place = {i: n for n, i in enumerate(ids)}
        names, above, links = rows.column("names"), {r: r for r in roots}, []

        def top(root: int) -> int:
            while above[root] != root:
                above[root] = root = above[above[root]]
            return root

        for n, partners in enumerate(rows.column("partners").to_pylist()):
            own = np.frombuffer(names[n].as_py(), np.uint64)
            for other in partners or ():
                one, two = top(roots[n]), top(roots[place[other]])
                if one != two and alike(own, np.frombuffer(names[place[other]].as_py(), np.uint64), percent):
                    above[max(one, two)] = min(one, two)
                    links.append((min(ids[n], other), max(ids[n], other)))
        return pa.table({x: pa.array([link[k] for link in links], pa.int64()) for k, x in enumerate("ab")})

    block = ["key", "x", "y", "part"]
    return asked.join(sets, F.col("id") == F.col("of")).select(*block, "id", "root", "partners", "names").groupBy(*block).applyInArrow(run, "a long, b long")


def link(classes: DataFrame, docs: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """Components (id, root) of ``classes`` (id, n_shingles, bands, samples, sketch)."""
    buckets = classes.select("id", F.posexplode("bands").alias("band", "key"))
    kind = F.xxhash64("id", F.col("band") % LEADS)
    first = buckets.groupBy("key").agg(F.min_by("id", kind).alias("lead"), F.count("*").alias("n")).filter("n > 1")
    first = first.select(F.col("key").alias("of"), "lead", "n")
    shared, path = common.store(buckets.join(first, F.col("key") == F.col("of")).select("key", "id", "lead", "n"), "near-buckets")
    pairs = shared.filter("lead <> id").select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b"))
    links, _ = common.store(confirm(candidates(pairs, classes, percent), docs, doc_id, text, percent), "near-links")
    groups, _ = common.store(components(links), "near-groups")
    # Members that have not led; a bucket of two is settled.
    members, old = common.store(shared.filter("n > 2 and lead <> id").select("key", "id"), "near-members")
    common.discard(classes.sparkSession, path)
    for likeliest in (True, False):
        placed, _ = common.store(in_open_buckets(members, groups), "near-open")
        if placed.isEmpty():
            break
        asked, _ = common.store(between_components(placed, classes, percent, likeliest), "near-between")
        sets, _ = common.store(sets_of(asked, docs, doc_id, text), "near-sets")
        new, _ = common.store(spanning_links(asked, sets, percent).distinct(), "near-more-links")
        if not new.isEmpty():
            links = links.unionByName(new)
            groups, _ = common.store(components(links), "near-groups")
    common.discard(classes.sparkSession, old)
    return groups


def in_open_buckets(members: DataFrame, groups: DataFrame) -> DataFrame:
    """(key, id, root, main) of the members of buckets with several components; main is the largest one's root."""
    known = groups.select(F.col("id").alias("of"), "root")
    placed = members.join(known, F.col("id") == F.col("of"), "left").select("key", "id", F.coalesce("root", "id").alias("root"))
    counts = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    main = counts.groupBy("key").agg(F.max(F.struct("n", "root")).alias("main"), F.count("*").alias("groups")).filter("groups > 1")
    main = main.select(F.col("key").alias("of"), F.col("main.root").alias("main"))
    return placed.join(main, F.col("key") == F.col("of")).select("key", "id", "root", "main")


def near_duplicates(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, text_hash, component_id, kept."""
    signed, _ = common.store(sign(docs, doc_id, text), "near-signed")
    one_each = signed.filter("digest is not null and doc_id is not null")
    classes = one_each.groupBy("digest").agg(F.min("doc_id").alias("id"))
    # Signatures of the class's smallest id; equal sets have equal ones. Stored: both joins with the
    # documents read it plainly, so that Spark can split the rows of a set a third of them share.
    ids = classes.select(F.col("id").alias("of"), F.col("digest").alias("of_digest"))
    full = one_each.join(ids, (F.col("doc_id") == F.col("of")) & (F.col("digest") == F.col("of_digest"))).dropDuplicates(["of", "of_digest"])
    full, _ = common.store(full.select(F.col("of").alias("id"), "n_shingles", "digest", "bands", "samples", "sketch"), "near-classes")
    groups = link(full, docs, doc_id, text, percent).select(F.col("id").alias("__id"), "root")
    by_digest = full.select(F.col("digest").alias("__digest"), F.col("id").alias("class_id")).join(groups, F.col("class_id") == F.col("__id"), "left")
    by_digest, _ = common.store(by_digest.select("__digest", F.coalesce("root", "class_id").alias("class_root")), "near-roots")
    rows = signed.select("doc_id", "n_shingles", "digest", "text_hash").join(by_digest, F.col("digest") == F.col("__digest"), "left")
    component = F.coalesce("class_root", "doc_id")
    return rows.select("doc_id", "n_shingles", "text_hash", F.when(F.col("doc_id").isNotNull(), component).alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
