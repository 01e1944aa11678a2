"""A corpus for training from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept, which is written and
read again between them. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm import common, decontaminate, mixing, near_dup, quality, suffix_dedup

ORACLE_SQL = None  # learned scores and hashed choices: tested against brute force


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go."""
    common.prepare(spark)
    net = quality.train(docs, common.table(spark, sf_dir, "labels"))
    column = common.free_name(docs, "score")
    return quality.score(docs, net, column=column).filter(F.col(column) >= quality.ACCEPT).drop(column)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more the one with the smallest id stays."""
    common.prepare(spark)
    judged = near_dup.near_duplicates(docs, percent=80)
    # By id and text: of an id that repeats, a text that is a copy goes and another one stays.
    gone = judged.filter("not kept").select(F.col("doc_id").alias("__gone"), F.col("text_hash").alias("__gone_text")).distinct()
    return docs.join(gone, (F.col("doc_id") == F.col("__gone")) & (near_dup.text_hash("text") == F.col("__gone_text")), "left_anti")


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a smaller document has go; a text of which nothing is left goes with its row."""
    common.prepare(spark)
    names = [common.free_name(docs, n) for n in suffix_dedup.RESULT_NAMES]
    left = suffix_dedup.remove_repeats(docs, names=names)
    whole = left.filter((F.col(names[0]) == 0) | (F.col(names[1]) < F.col(names[0])))
    size = F.when(F.col(names[1]) > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return whole.withColumn("n_chars", size).select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    common.prepare(spark)
    return decontaminate.drop_leaks(docs, common.table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources get their share; a document taken twice is two rows, numbered by ``copy``."""
    common.prepare(spark)
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("suffix-array dedup", suffix_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = common.store(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
