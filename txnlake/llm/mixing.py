"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

A source takes ``target / source_size`` copies of each of its documents, at most ``MOST_COPIES``. The
whole part is taken at once; the fraction is a probability. Pairs of fractions exchange mass (in words)
until one of the two is 0 or 1, at random but so that every expectation stays; blocks of about ``BLOCK``
documents fold this way, each leaves one residual, and residuals form the blocks of the next level until
one is left per source. The words taken by a source thus miss its target by less than one document; long
documents go first, so that the one left is mostly a short one.
Blocks are hashed within a source, so a source with a third of all rows is many blocks. All
randomness is a hash of the id, the level and the seed, and blocks are sorted: reruns agree.

Defined cases: a null text and an empty one have size 0 and are taken 0 times; a null source is a source
of its own, last in order; rows that repeat id, source and size are rounded together; no rows give no rows;
a source of size 0 has target 0. A null id is an id like any other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnlake.llm import common

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2
BLOCK = 64
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """Per source its size and target words: ``share`` of all words by repeating ``weights``, capped.

    Water filling in closed form: sources in order of cap per weight; the first that stays below its
    cap fixes the common level for all that follow. One row per source goes through one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("place", F.row_number().over(by_name) - 1)
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = per.withColumn("level", left / open_weight)
    # Below the level every source is capped; the level of the first source above it holds for the rest.
    level = level.withColumn("free", F.max(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))).over(everything))
    return level.select("source", "source_size", F.least("cap", F.coalesce(F.col("free") * F.col("weight"), F.col("cap"))).alias("target"))


# A step of the fold: s.c is the open document, x the next. Mass (p times size) moves one way with the
# probability that keeps both expectations; at least one of the two ends at 0 or 1.
_STEP = """
aggregate(
  units,
  named_struct('open', cast(null as struct<unit:bigint,w:double,p:double,u:double>), 'done', cast(array() as array<struct<unit:bigint,up:int>>)),
  (s, x) -> case
    when s.open is null then named_struct('open', x, 'done', s.done)
    else transform(array(named_struct(
        'rise', least((1 - s.open.p) * s.open.w, x.p * x.w),
        'fall', least(s.open.p * s.open.w, (1 - x.p) * x.w))),
      m -> case when x.u * (m.rise + m.fall) < m.fall then
        case when (1 - s.open.p) * s.open.w <= x.p * x.w
          then named_struct('open', case when x.p * x.w - m.rise > 0 and (1 - s.open.p) * s.open.w < x.p * x.w then named_struct('unit', x.unit, 'w', x.w, 'p', (x.p * x.w - m.rise) / x.w, 'u', x.u) end,
            'done', concat(s.done, array(named_struct('unit', s.open.unit, 'up', 1)), if(x.p * x.w - m.rise > 0 and (1 - s.open.p) * s.open.w < x.p * x.w, cast(array() as array<struct<unit:bigint,up:int>>), array(named_struct('unit', x.unit, 'up', 0)))))
          else named_struct('open', named_struct('unit', s.open.unit, 'w', s.open.w, 'p', (s.open.p * s.open.w + m.rise) / s.open.w, 'u', s.open.u),
            'done', concat(s.done, array(named_struct('unit', x.unit, 'up', 0))))
        end
      else
        case when s.open.p * s.open.w <= (1 - x.p) * x.w
          then named_struct('open', case when s.open.p * s.open.w < (1 - x.p) * x.w then named_struct('unit', x.unit, 'w', x.w, 'p', (x.p * x.w + m.fall) / x.w, 'u', x.u) end,
            'done', concat(s.done, array(named_struct('unit', s.open.unit, 'up', 0)), if(s.open.p * s.open.w < (1 - x.p) * x.w, cast(array() as array<struct<unit:bigint,up:int>>), array(named_struct('unit', x.unit, 'up', 1)))))
          else named_struct('open', named_struct('unit', s.open.unit, 'w', s.open.w, 'p', (s.open.p * s.open.w - m.fall) / s.open.w, 'u', s.open.u),
            'done', concat(s.done, array(named_struct('unit', x.unit, 'up', 1))))
        end
      end)[0]
    end)
"""


def _uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def round_fractions(units: DataFrame, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """``units`` (place, unit, w, p), p in (0, 1), w > 0, unit distinct, to (unit, up): 1 if rounded up.

    One level per factor of ``block``; each level is stored, so lost executors redo one level only.
    """
    spark = units.sparkSession
    done, level = None, 0
    largest = units.groupBy("place").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    while largest > 0:
        blocks = max(1, math.ceil(largest / block)) if largest > block else 1
        dealt = units.withColumn("block", F.pmod(F.xxhash64("unit", F.lit(seed), F.lit(level)), F.lit(blocks)))
        dealt = dealt.withColumn("u", _uniform(F.col("unit"), F.lit(seed + 1), F.lit(level)))
        order = F.array_sort(F.collect_list(F.struct((-F.col("w")).alias("k"), "unit", "w", "p", "u")))
        folded = dealt.groupBy("place", "block").agg(F.transform(order, lambda x: F.struct(x["unit"].alias("unit"), x["w"].alias("w"), x["p"].alias("p"), x["u"].alias("u"))).alias("units"))
        folded, _ = common.store(folded.select("place", F.expr(_STEP).alias("made")), f"mix-level{level}")
        decided = folded.select(F.explode("made.done").alias("d")).select("d.unit", "d.up")
        left = folded.filter("made.open is not null").select("place", "made.open.unit", "made.open.w", "made.open.p")
        if blocks == 1:
            last = left.select("unit", (_uniform(F.col("unit"), F.lit(seed + 3)) < F.col("p")).cast("int").alias("up"))
            decided, largest = decided.unionByName(last), 0
        else:
            units, level = left, level + 1
            largest = units.groupBy("place").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
        done = decided if done is None else done.unionByName(decided)
    return done if done is not None else spark.createDataFrame([], "unit long, up int")


def _rated(sized: DataFrame, goal: DataFrame, source: str, doc_id: str, size: str, most: float) -> DataFrame:
    """``sized`` with its source's size, target, whole copies, fraction, and the number of its unit.

    Rows that repeat id, source and size are one unit, whose number is a 64-bit hash of them.
    """
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    goal = goal.select(F.col("source").alias("__source"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), F.floor(rate).alias("__whole"), (rate - F.floor(rate)).alias("__part"), F.xxhash64("source", F.col("source").isNull()).alias("__place"))
    wide = sized.join(goal, F.col(source).eqNullSafe(F.col("__source"))).drop("__source")
    return wide.withColumn("__unit", F.xxhash64(F.col(doc_id), F.col(doc_id).isNull(), F.col("__place"), F.col(size)))


def _rounded(wide: DataFrame, ups: DataFrame) -> DataFrame:
    """Add ``__copies``, the number of times a row is taken."""
    ups = ups.select(F.col("unit").alias("__of"), "up")
    joined = wide.join(ups, F.col("__unit") == F.col("__of"), "left")
    return joined.withColumn("__copies", (F.col("__whole") + F.coalesce("up", F.lit(0))).cast("int")).drop("__of", "up")


def _solve(docs: DataFrame, doc_id: str, text: str, source: str, weights: tuple[float, ...], share: float, most: float, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored sizes, stored targets, and the rounding of every unit."""
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    sized, _ = common.store(sized, "mix-sizes")
    goal, _ = common.store(targets(sized, weights, share, most), "mix-targets")
    wide = _rated(sized, goal, "source", "doc_id", "size", most)
    units = wide.filter("size > 0 and __part > 0").groupBy(F.col("__place").alias("place"), F.col("__unit").alias("unit"))
    units = units.agg(F.sum("size").cast("double").alias("w"), F.first("__part").alias("p"))
    return wide, goal, round_fractions(units, seed)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words, repeats counted)."""
    wide, _, ups = _solve(docs, doc_id, text, source, weights, share, most, seed)
    taken = (F.col("size") * F.col("__copies")).cast("long")
    return _rounded(wide, ups).select("doc_id", "source", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), taken.alias("taken"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: int = 7) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the number of the copy in ``copy``."""
    _, goal, ups = _solve(docs, doc_id, text, source, weights, share, most, seed)
    copy = common.free_name(docs, "copy")
    wide = _rated(docs.withColumn("__size", word_count(F.col(text))), goal, source, doc_id, "__size", most)
    rows = _rounded(wide, ups).filter("__copies > 0")
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias(copy))
