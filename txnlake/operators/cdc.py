"""Change images: latest per key and deletes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_images(df: DataFrame, key: str = "id", order: str = "lsn") -> DataFrame:
    """The image with the largest ``order`` per key.

    A maximum over structs folds the images of a key before the shuffle, so a key with very many
    updates is no larger than any other. The remaining columns only break ties.
    """
    rest = [c for c in df.columns if c not in (key, order)]
    best = F.max(F.struct(order, *rest)).alias("_best")
    return df.groupBy(key).agg(best).select(key, *[f"_best.{c}" for c in [order, *rest]])


def live_rows(df: DataFrame, key: str = "id", order: str = "lsn", deleted: str = "deleted") -> DataFrame:
    """Latest images without tombstones (no key) and without keys whose latest image is a delete."""
    return latest_images(df.where(F.col(key).isNotNull()), key, order).where(~F.coalesce(F.col(deleted), F.lit(False)))
