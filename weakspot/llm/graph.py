"""Connected components of an edge table, and all-pairs work cut into pairs of blocks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from weakspot.llm.common import pinned


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of an edge with the smallest node of its component.

    Edges (a, b) of longs are turned into stars in rounds: each node passes the
    smallest neighbour on to its larger neighbours, then to its smaller ones.  Both
    steps are a minimum per node, combined before the shuffle, and a join, whose hot
    keys adaptive execution can split.  Rounds grow with the logarithm of a
    component's width.  Each round's edges are kept in the shared folder.
    """
    edges = pinned(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    )
    before = None
    while True:
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == before:
            break
        before = now
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
        large = edges.join(least, "b").select("a", F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = pinned(small.union(least.select("a", F.col("m").alias("b"))).distinct())
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centres)


def local_roots(linked: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component, for a symmetric matrix of links among rows."""
    roots = np.arange(len(linked))
    while True:
        # smallest root among a row and those it is linked with, then the root's own root
        best = np.minimum(roots, np.where(linked, roots[None, :], len(roots)).min(axis=1, initial=len(roots)))
        best = best[best]
        if (best == roots).all():
            return roots
        roots = best
