"""Connected components of links, by alternating large-star and small-star
steps: every step is a grouped minimum and a join on the node, so a node with
any number of links is pre-aggregated and its join can be split."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Of links (a, b) inside a task only those that join what isn't joined yet."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    left, right = [], []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            left.append(x)
            right.append(y)
    return left, right


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Large star: all larger neighbours of a node move to its least neighbour
    (or itself). Small star: all smaller ones and the node do."""
    if larger:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
    else:
        down = edges.select(F.col("b").alias("n"), F.col("a").alias("s"))  # a < b
        least = down.groupBy("n").agg(F.min("s").alias("m"))
        moved = (down.join(least, "n").select(F.col("m").alias("a"), F.col("s").alias("b"))
                 .union(least.select(F.col("m").alias("a"), F.col("n").alias("b"))))
    return moved.where("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b: long, not null); the
    component is the least node that links reach. Loops and repeats are ignored."""
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    edges = materialise(edges, "links")
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
        edges = materialise(_stars(_stars(edges, True), False), "links")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
