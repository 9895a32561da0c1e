"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.sources.scratch import written


def _stars(edges: DataFrame, label: str) -> DataFrame:
    """One large-star and one small-star step. Each is a minimum per node (combined before the shuffle)
    joined back to the links, so the links of a hub are spread by the join, never gathered."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
    large = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = written(large.where("a != b").distinct(), f"{label}-large")
    # every link now points from the larger node to a smaller one
    least = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    moved = large.join(least, F.col("a") == F.col("n")).select("a", "b", "m")
    small = moved.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    small = small.union(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return written(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), f"{label}-small")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node of its component.

    Self-links and repeated links do no harm; rows with a null end are ignored; no links give no rows.
    Each round is written to the shared folder, so lineage stays short and lost executors cost one round.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.where("a != b").select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    edges = written(edges, "links")
    before = _mark(edges)
    while before[0]:
        edges = _stars(edges, "stars")
        after = _mark(edges)
        if after == before:
            break
        before = after
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(own)
