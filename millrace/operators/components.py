"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import written_counting


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written out, with their number and a digest of them."""
    stored, seen = written_counting(
        edges, "edges", n=F.count(F.lit(1)), digest=F.bit_xor(F.xxhash64("u", "v"))
    )
    return stored, (seen["n"], seen["digest"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
    low = low.select("k", F.least("k", "m").alias("m"))
    linked = both.where("v > u").join(low, F.col("u") == F.col("k"))
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
    linked = edges.join(low, F.col("u") == F.col("k")).where("v <> m")
    moved = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = low.select(F.col("k").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(kept).distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node on an edge; the root is the smallest node of its component.

    ``edges`` holds ``a, b``. Each round hangs neighbours onto the smallest node seen; minima
    are partial aggregates, so a node with very many edges is never gathered in one task. The
    edge table is written out per round, which keeps the plan short and survives lost executors.
    """
    current = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    current, before = _stored(current)
    while before[0]:
        current, after = _stored(_small_star(_large_star(current)))
        if after == before:
            break
        before = after
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
