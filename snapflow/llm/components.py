"""Connected components of an edge table by alternating star contraction.

Every round is two aggregations and two joins over the edges; the edges are checkpointed into the shared
checkpoint folder after each round. Nothing of the graph reaches the driver but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.session import reliable_checkpoint


def _hang(edges: DataFrame) -> DataFrame:
    """Hang each node's larger neighbours on the least of its neighbourhood (large star)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("k"), F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, F.col("u") == F.col("k"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _gather(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the least of them (small star); edges run from larger to
    smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    down = edges.join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.where("u <> v").union(least.select(F.col("k").alias("u"), F.col("m").alias("v")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge to another; root is the least node reachable.

    ``edges`` has two long columns; direction, repeats and self-loops don't matter, rows with a null end are
    no edges. No edges: an empty result.
    """
    e = (edges.where(F.col(a) != F.col(b))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e, before = reliable_checkpoint(e), None
    while True:
        seen = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v"), F.col("v")).distinct())
        before = seen
        e = reliable_checkpoint(_gather(_hang(e).where("u <> v").distinct()).distinct())
