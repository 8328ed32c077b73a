"""Connected components by large-star and small-star rounds.

Each round links all neighbours of a node to the smallest one, seen from above
(large star) and from below (small star); the number of rounds grows with the
logarithm of the graph, also for long chains.  No neighbourhood is ever collected: a
round is a minimum per node (combined map-side) joined back to the edges, so a hub
with a third of all edges is a skewed join at most, which adaptive execution splits.
Before the first round every partition contracts its own edges to stars, a bounded
chunk at a time.  Rounds are written to the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch

#: Edges that one task contracts at a time.
CHUNK = 250_000
MAX_ROUNDS = 60


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges of a partition as stars around the smallest node of each local component."""

    def stars(parent: dict) -> pd.DataFrame:
        nodes, roots = [], []
        for x in parent:
            r = x
            while parent[r] != r:
                r = parent[r]
            if r != x:
                nodes.append(x)
                roots.append(r)
        return pd.DataFrame({"x": nodes, "y": roots}, dtype="object")

    parent: dict[str, str] = {}
    seen = 0
    for pdf in batches:
        for a, b in zip(pdf.x, pdf.y):
            for n in (a, b):
                if n not in parent:
                    parent[n] = n
            while parent[a] != a:
                parent[a] = parent[parent[a]]
                a = parent[a]
            while parent[b] != b:
                parent[b] = parent[parent[b]]
                b = parent[b]
            if a != b:
                parent[max(a, b)] = min(a, b)
        seen += len(pdf)
        if seen >= CHUNK:
            yield stars(parent)
            parent, seen = {}, 0
    if parent:
        yield stars(parent)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    least = both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("u"), F.least("x", "m").alias("m"))
    return both.where("y > x").join(least, F.col("x") == F.col("u")).select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("x").agg(F.min("y").alias("m"))
    moved = edges.join(least.withColumnRenamed("x", "u"), F.col("x") == F.col("u")).where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
    return moved.unionByName(least.select("x", F.col("m").alias("y"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node with an edge; a component bears its smallest node.

    Edges are undirected; repeated edges, loops and other columns do not matter.  Rows with
    a null end are no edges.  No edges give no rows; a node whose only edges are loops has
    its own component.
    """
    spark = edges.sparkSession
    ends = edges.select(F.col(a).cast("string").alias("x"), F.col(b).cast("string").alias("y")).where("x is not null and y is not null")
    scratch = Scratch(spark, "components")
    now = scratch.write(ends.where("x <> y").mapInPandas(_contract, "x string, y string"))
    schema = "x string, y string"
    mark = None
    for _ in range(MAX_ROUNDS):
        at = spark.read.schema(schema).parquet(now)
        done = scratch.write(_small_star(_large_star(at)))
        scratch.drop(now)
        now = done
        after = spark.read.schema(schema).parquet(now).agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(20,0)"))).first()
        if tuple(after) == mark:
            break
        mark = tuple(after)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    stars = spark.read.schema(schema).parquet(now).select(F.col("x").alias("node"), F.col("y").alias("component"))
    roots = stars.select(F.col("component").alias("node"), "component").distinct()
    alone = ends.where("x = y").select(F.col("x").alias("node")).distinct().join(stars.select("node").unionByName(roots.select("node")), "node", "left_anti")
    return stars.unionByName(roots).unionByName(alone.select("node", F.col("node").alias("component")))
