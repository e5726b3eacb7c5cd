"""Connected components of a link table, by rounds of joins; only a counted few edges meet in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, staged


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _together(edges: DataFrame, few: bool) -> DataFrame:
    """A few edges in one partition, where grouping and joining need no shuffle."""
    return edges.coalesce(1) if few else edges


def _to_smallest_of_all(edges: DataFrame, few: bool) -> DataFrame:
    """Each node sends its larger neighbours to the smallest of its neighbourhood."""
    both = _together(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), few)
    smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(smallest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _to_smallest_of_smaller(edges: DataFrame, few: bool) -> DataFrame:
    """Each node sends itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(smallest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _together(moved.unionByName(smallest.withColumnRenamed("m", "b")), few).distinct()


#: Edges that one task handles without any shuffle, a few megabytes.
FEW = 250_000


def components(edges: DataFrame) -> DataFrame:
    """``a, b``: every node of ``edges (a, b)`` but the smallest of its component, and that one.

    The two steps in turn shrink every component to a star in a few rounds, also long chains.
    Nodes are longs; loops and repeated edges do no harm.  Up to ``FEW`` edges are one partition,
    where the rounds need no shuffle; more are dealt by node.
    """
    edges = staged(edges.filter("a <> b").distinct(), "links")
    state = _state(edges)
    while True:
        few = state[0] <= FEW
        new = staged(_to_smallest_of_smaller(_to_smallest_of_all(_together(edges, few), few), few), "links")
        release(edges)
        edges, before, state = new, state, _state(new)
        if state == before:
            return edges
