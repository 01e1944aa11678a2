"""Source divergence audit: how differently the sources of a language use its terms.

Stripes. Tasks fold whole documents into a hash table, term to (document frequency, count per source), and spill it as
rows whenever it holds ``SPILL_COUNTS`` counts, so that a frequent term leaves a task once per spill and not once per
document. Spark merges the rows by (language, term) in one shuffle, sums counts by source, and keeps terms of at least
``min_docs`` documents of their language.

Divergences. Every group (language, source) gives every kept term the share p = 1 + floor(10^9 (count + 5) / (N + 5 V)),
all in whole numbers. Merged stripes are cut by term hash to pieces of some ``PIECE_TERMS`` terms; a piece becomes a matrix
of shares and emits, for each two groups, the sum of abs(p - q) beyond what two absent terms give, and its own best terms
per group. Spark adds up the sums and ranks. Languages of more than ``BLOCK_SOURCES`` sources are compared block by
block, so a matrix is never wider than two blocks.

Defined cases: null language, source or text is the empty string; every group that occurs is there, also without terms or
where its language keeps none (all divergences 0); a language of one source has no pairs; equal values rank by the item's
UTF-8 bytes; repeated rows count as documents of their own; an empty table gives no rows. Totals must stay below 9 * 10^15
tokens per language.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlake.llm import common

MIN_DOCS = 30
TOP_TERMS = 50
SPILL_COUNTS = 400_000
PIECE_TERMS = 4096
BLOCK_SOURCES = 256
SLICE = 1 << 20
SCALE = 1_000_000_000
SMOOTHING = 5
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")  # letters A-Z and all that is not ASCII
STRIPE = "lang string, term string, docs long, sources array<string>, counts array<long>"


def terms_of(text: bytes, size: int = SLICE) -> Counter:
    """Occurrences of each term; long texts in slices that end between terms."""
    counts: Counter = Counter()
    begun = 0
    while begun < len(text):
        end = begun + size
        while end < len(text) and TERM.match(text, end - 1, end + 1) and TERM.match(text, end):
            end += 1
        counts.update(TERM.findall(text[begun:end].lower()))
        begun = end
    return counts


def stripes(docs: DataFrame) -> DataFrame:
    """Partial stripes of every task, from columns lang, source, text without nulls."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[bytes, list]] = {}
        size = 0

        def spilled():
            for lang, table in held.items():
                rows = [(t.decode("utf-8"), d, list(c), list(c.values())) for t, (d, c) in table.items()]
                for i in range(0, len(rows), 10_000):
                    terms, docs_of, sources, counts = zip(*rows[i : i + 10_000], strict=True)
                    columns = [pa.array([lang] * len(terms)), pa.array(terms), pa.array(docs_of, pa.int64()), pa.array(sources, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "docs", "sources", "counts"])

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                table = held.setdefault(lang, {})
                for term, n in terms_of(text.as_buffer().to_pybytes()).items():
                    stripe = table.get(term)
                    if stripe is None:
                        table[term] = [1, {source: n}]
                        size += 1
                    else:
                        stripe[0] += 1
                        counts = stripe[1]
                        if source in counts:
                            counts[source] += n
                        else:
                            counts[source] = n
                            size += 1
                if size >= SPILL_COUNTS:
                    yield from spilled()
                    held, size = {}, 0
        yield from spilled()

    return docs.select("lang", "source", "text").mapInArrow(run, STRIPE)


def merged(partial: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One stripe per (language, term) of enough documents. Both sums share the one shuffle by (language, term)."""
    dealt = partial.repartition("lang", "term")
    flat = dealt.select("lang", "term", "docs", F.posexplode(F.arrays_zip("sources", "counts")).alias("place", "entry"))
    own = F.when(F.col("place") == 0, F.col("docs")).otherwise(F.lit(0))  # once per partial stripe
    by_source = flat.groupBy("lang", "term", F.col("entry.sources").alias("source")).agg(F.sum(own).alias("docs"), F.sum("entry.counts").alias("n"))
    whole = by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("stripe"))
    return whole.where(F.col("docs") >= min_docs).select("lang", "term", "docs", "total", F.col("stripe.source").alias("sources"), F.col("stripe.n").alias("counts"))


def share(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 5) / whole), digit by digit so that nothing overflows."""
    rest, out = counts + SMOOTHING, 0
    for _ in range(3):
        out, rest = out * 1000 + rest * 1000 // whole, rest * 1000 % whole
    return out + 1


EMITTED = "lang string, i int, j int, term string, value long"
_EMITTED = pa.schema([("lang", pa.string()), ("i", pa.int32()), ("j", pa.int32()), ("term", pa.string()), ("value", pa.int64())])


def _emit(piece: pa.Table, about: pa.Table, top: int, wide: int) -> pa.Table:
    """Of one piece of a language and one pair of blocks of its sources: sums for each two groups, best terms of each group."""
    if not piece.num_rows or not about.num_rows:
        return _EMITTED.empty_table()
    known = {n: about.column(n)[0].as_py() for n in about.column_names}
    lang, first, second = known["lang"], known["block_a"] * wide, known["block_b"] * wide
    same, width = first == second, len(known["sources_a"])
    names = known["sources_a"] + ([] if same else known["sources_b"])
    whole = np.array(known["whole_a"] + ([] if same else known["whole_b"]), np.int64)
    lists, counts = piece.column("sources").combine_chunks(), piece.column("counts").combine_chunks().flatten().to_numpy()
    place = pc.index_in(lists.flatten(), value_set=pa.array(names, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(piece.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
    of = np.zeros((piece.num_rows, len(names)), np.int64)
    of[row[place >= 0], place[place >= 0]] = counts[place >= 0]
    p, absent = share(of, whole), share(np.zeros(len(names), np.int64), whole)
    a, b = p[:, :width], (p if same else p[:, width:])
    absent_b = absent if same else absent[width:]
    i_of, j_of, terms, values = [], [], [], []
    for i in range(width):
        beyond = np.abs(a[:, i : i + 1] - b).sum(axis=0) - piece.num_rows * np.abs(absent[i] - absent_b)
        others = [j for j in range(len(absent_b)) if not same or j != i]
        for x, y in [([first + i] * len(others), [second + j for j in others])] + ([] if same else [([second + j for j in others], [first + i] * len(others))]):
            i_of += x
            j_of += y
            values += beyond[others].tolist()
            terms += [None] * len(others)
    if same:
        words = piece.column("term").to_pylist()
        rank = np.empty(len(words), np.int64)
        rank[sorted(range(len(words)), key=lambda k: words[k].encode())] = np.arange(len(words))
        over = p - share(piece.column("total").to_numpy(), np.int64(known["whole_lang"]))[:, None]
        for i in range(width):
            good = np.flatnonzero((of[:, i] > 0) & (over[:, i] > 0))
            best = good[np.lexsort((rank[good], -over[good, i]))[:top]]
            i_of += [first + i] * len(best)
            j_of += [-1] * len(best)
            terms += [words[k] for k in best]
            values += over[best, i].tolist()
    columns = [[lang] * len(values), i_of, j_of, terms, values]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _EMITTED, strict=True)], schema=_EMITTED)


def _groups(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per occurring group: its number in the language, N + 5 V, V, and the same of the language."""
    seen = rows.select("lang", "source").distinct()
    counted = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    tokens = counted.groupBy("lang", F.col("e.sources").alias("source")).agg(F.sum("e.counts").alias("n"))
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("all"))
    both = seen.join(tokens, ["lang", "source"], "left").join(terms, "lang", "left").na.fill(0, ["n", "v", "all"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    smooth = F.col("v") * SMOOTHING
    return both.select("lang", "source", "v", number.alias("i"), (F.col("n") + smooth).alias("whole"), (F.col("all") + smooth).alias("whole_lang"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): divergence to each other source, and the terms a source overuses."""
    blank = F.lit("")
    rows = docs.select(*[F.coalesce(F.col(c), blank).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    kept, _ = common.store(merged(stripes(rows), min_docs), "divergence-stripes")
    groups, _ = common.store(_groups(rows, kept), "divergence-groups")
    # Two numbers: the most terms of a language, the most sources of a language.
    most = groups.agg(F.coalesce(F.max("v"), F.lit(0)).alias("v"), F.coalesce(F.max("i"), F.lit(0)).alias("i")).first()
    wide = BLOCK_SOURCES
    pieces, blocks = max(1, -(-most["v"] // PIECE_TERMS)), most["i"] // wide + 1

    block = F.floor(F.col("i") / wide).cast("int")
    members = F.array_sort(F.collect_list(F.struct("i", "source", "whole")))
    blocked = groups.groupBy("lang", "whole_lang", block.alias("block")).agg(members.alias("m"))
    side = lambda s: [F.col("block").alias(f"block_{s}"), F.col("m.source").alias(f"sources_{s}"), F.col("m.whole").alias(f"whole_{s}")]
    about = blocked.select("lang", "whole_lang", *side("a")).join(blocked.select("lang", *side("b")), "lang").where("block_a <= block_b")
    about = about.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    pair = F.explode(F.sequence(F.lit(0), F.lit(blocks * blocks - 1))).alias("pair")
    dealt = kept.select("lang", "term", "total", "sources", "counts", F.pmod(F.xxhash64("term"), F.lit(pieces)).cast("int").alias("piece"), pair)
    dealt = dealt.withColumn("block_a", F.floor(F.col("pair") / blocks).cast("int")).withColumn("block_b", (F.col("pair") % blocks).cast("int")).where("block_a <= block_b").drop("pair")
    keys = ["lang", "piece", "block_a", "block_b"]
    emitted = dealt.groupBy(*keys).cogroup(about.groupBy(*keys)).applyInArrow(lambda piece, known: _emit(piece, known, top, wide), EMITTED)
    emitted, _ = common.store(emitted, "divergence-emitted")

    absent = F.expr(f"{SCALE * SMOOTHING} div whole + 1")
    named = groups.where("v > 0").select("lang", "source", "i", "v", absent.alias("absent")).unionByName(groups.where("v = 0").select("lang", "source", "i", "v", F.lit(0).cast("long").alias("absent")))
    other = named.select("lang", F.col("source").alias("item"), F.col("i").alias("j"), F.col("absent").alias("absent_j"))
    sums = emitted.where("j >= 0").groupBy("lang", "i", "j").agg(F.sum("value").alias("beyond"))
    pairs = named.join(other, "lang").where("i <> j").join(sums, ["lang", "i", "j"], "left")
    value = F.coalesce(F.col("beyond"), F.lit(0)) + F.col("v") * F.abs(F.col("absent") - F.col("absent_j"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    order = [F.desc("value"), F.asc("item")]
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    best = emitted.where("j < 0").select("lang", "i", F.col("term").alias("item"), "value")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "i").orderBy(*order))).where(F.col("rank") <= top)
    best = best.join(groups.select("lang", "i", "source"), ["lang", "i"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.unionByName(best)
