"""Connected components of links by contraction.

Every vertex that has a smaller neighbour hooks to the smallest; pointers are followed to their roots by
doubling; links between roots are the next round's. A round leaves at most half of the vertices that
still have links. All steps are joins and folded minima, so a vertex with a third of all links is
no bottleneck, and every round is stored in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm import common


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to (id, root): the smallest id of the component, for every id that has a link."""
    spark = links.sparkSession
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    edges, path = common.store(edges, "links")
    labels: DataFrame | None = None
    while not edges.isEmpty():
        parents, old = common.store(edges.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("root")), "parents")
        while True:
            up = parents.select(F.col("id").alias("of"), F.col("root").alias("above"))
            jumped = parents.join(up, F.col("root") == F.col("of"), "left")
            moved = jumped.select("id", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
            moved, new = common.store(moved, "parents")
            parents = moved.select("id", "root")
            common.discard(spark, old)
            old = new
            if moved.filter("moved").isEmpty():
                break
        roots = parents.select(F.col("id").alias("of"), F.col("root").alias("above"))
        if labels is None:
            labels = parents
        else:
            lifted = labels.join(roots, F.col("root") == F.col("of"), "left").select("id", F.coalesce("above", "root").alias("root"))
            # Roots of earlier rounds that have hooked now are ids of their own.
            labels = lifted.unionByName(parents.join(labels.select(F.col("id").alias("known")), F.col("id") == F.col("known"), "left_anti"))
        labels, _ = common.store(labels, "labels")
        mapped = edges.join(roots, F.col("a") == F.col("of"), "left").select(F.coalesce("above", "a").alias("a"), "b")
        mapped = mapped.join(roots, F.col("b") == F.col("of"), "left").select("a", F.coalesce("above", "b").alias("b"))
        mapped = mapped.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        edges, new = common.store(mapped, "links")
        common.discard(spark, path)
        path = new
    if labels is None:
        return spark.createDataFrame([], "id long, root long")
    smallest = labels.select("root").distinct().select(F.col("root").alias("id"), "root")
    return labels.unionByName(smallest).distinct()
