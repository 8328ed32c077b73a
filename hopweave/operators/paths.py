"""Bounded search for simple paths in many small graphs at once, and strategies over it.

A breadth-first search that expands neighbours in list order finds paths ordered by
length, then by the sequence of adjacency ordinals.  So every hop is one equi-join of
the frontier with the adjacency on (graph, node), and the cap is a rank over (length,
ordinals) afterwards; parallel edges count before repeats are removed.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch

#: Waypoints up to which all orders are tried.
MAX_WAYPOINTS = 3


def adjacency(edges: DataFrame) -> DataFrame:
    """``id, source, type, target, adj_ord`` of ``id, source, type, target, ords``: the place of each edge among its source's edges.

    Ends and types are trimmed, rows with a blank one are no edges. Parallel edges stay.
    """
    cut = edges.select("id", *(F.trim(c).alias(c) for c in ("source", "type", "target")), "ords").where("source <> '' and type <> '' and target <> ''")
    # A window over the edges of one node of one question's graph.
    return cut.select("id", "source", "type", "target", F.row_number().over(Window.partitionBy("id", "source").orderBy("ords", "type", "target")).alias("adj_ord"))


def _distances(step: DataFrame, goals: DataFrame, hops: int) -> DataFrame:
    """``id, goal, node, far``: the nodes from which a goal can be reached in fewer than ``hops`` edges, with the least number of edges."""
    back = step.select("id", F.col("next").alias("at"), F.col("node").alias("before")).distinct()
    front = goals.select("id", "goal", F.col("goal").alias("node"), F.lit(0).alias("far")).distinct()
    every = front
    for far in range(1, hops):
        # A goal is never passed through, so nothing is searched behind it.
        moved = front.join(back, (front["id"] == back["id"]) & (front["node"] == back["at"])).where(F.col("before") != F.col("goal"))
        front = moved.select(front["id"], "goal", F.col("before").alias("node"), F.lit(far).alias("far")).distinct()
        every = every.unionByName(front)
    return every.groupBy("id", "goal", "node").agg(F.min("far").alias("far"))


def bounded_paths(adj: DataFrame, starts: DataFrame, hops: int, cap: int) -> DataFrame:
    """``id, source, goal, len, ords, path, rank``: up to ``cap`` simple paths of at most ``hops`` edges.

    ``starts`` has ``id, source, goal``; a start that is its goal has no path.  The goal is
    never passed through.  ``path`` is a list of ``s|p|o`` texts.  Distances to the goals are
    found first, backwards; the frontier takes only edges to nodes from which the goal can
    still be reached with the edges that are left, so it holds no way that leads nowhere.
    """
    step = adj.select("id", F.col("source").alias("node"), F.col("type").alias("p"), F.col("target").alias("next"), "adj_ord")
    wanted = starts.where("source <> goal").distinct()
    near = _distances(step, wanted.select("id", "goal"), hops)
    # Edges by goal, with the edges that are left at least behind each: one exchange serves all hops.
    scratch = Scratch(adj.sparkSession, "steps")
    useful = scratch.cut(step.join(near.select("id", "goal", F.col("node").alias("next"), "far"), ["id", "next"]).select("id", "goal", "node", "p", "next", "adj_ord", "far"))
    front = wanted.select("id", "source", "goal", F.col("source").alias("node"), F.array("source").alias("seen"), F.array().cast("array<int>").alias("ords"), F.array().cast("array<string>").alias("path"))
    hits = None
    for hop in range(hops):
        moved = front.join(useful, ["id", "goal", "node"]).where((F.col("far") <= hops - hop - 1) & ~F.array_contains("seen", F.col("next")))
        moved = moved.select("id", "source", "goal", F.col("next").alias("node"), F.array_append("seen", F.col("next")).alias("seen"), F.array_append("ords", F.col("adj_ord")).alias("ords"), F.array_append("path", F.concat_ws("|", "node", "p", "next")).alias("path"))
        found = moved.where("node = goal").select("id", "source", "goal", F.lit(hop + 1).alias("len"), "ords", "path")
        hits = found if hits is None else hits.unionByName(found)
        front = moved.where("node <> goal")
    rank = F.row_number().over(Window.partitionBy("id", "source", "goal").orderBy("len", "ords"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= cap)


def _capped(paths: DataFrame, order: list[str], cap: int) -> DataFrame:
    """``id, paths``: distinct paths, each at its first place by length and ``order``, at most ``cap``."""
    first = paths.groupBy("id", "path").agg(F.min(F.struct(F.size("path").alias("len"), *order)).alias("at"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "path")))
    return first.groupBy("id").agg(F.slice(ordered, 1, cap).alias("o")).select("id", F.col("o.path").alias("paths"))


def annotate_paths(questions: DataFrame, adj: DataFrame, cap: int = 20) -> DataFrame:
    """``id, strategy, paths`` of questions with ``id, seeds, answer``.

    0: the answer is a seed, reached through the other seeds in order, else from any of
    them; 1: reached through all seeds in some order, at most two hops each; 2: reached
    from any seed in four hops; 3: not reached.  A later strategy is tried only for
    questions that the earlier ones leave.  The adjacency, the short paths and the
    outcome of the first strategies are used several times, so each is written once.
    """
    scratch = Scratch(questions.sparkSession, "paths")
    adj = scratch.cut(adj)
    questions = scratch.cut(questions.select("id", "answer", "seeds"))
    q = questions.select("id", "answer", F.col("seeds"), F.filter("seeds", lambda s: s != F.col("answer")).alias("others"), F.array_contains("seeds", F.col("answer")).alias("seeded"))
    orders = F.when(F.col("seeded"), F.array(F.sequence(F.lit(0), F.size("others") - 1)))
    for n in range(1, MAX_WAYPOINTS + 1):
        orders = orders.when(F.size("others") == n, F.array(*(F.array(*map(F.lit, p)) for p in permutations(range(n)))))
    ways = q.where("size(others) > 0").select("id", "answer", "others", F.posexplode(orders).alias("perm", "order"))
    stops = F.array_append(F.transform("order", lambda i: F.get("others", i)), F.col("answer"))
    legs = ways.select("id", "perm", stops.alias("stops")).select("id", "perm", "stops", F.posexplode(F.slice("stops", 1, F.size("stops") - 1)).alias("leg", "source"))
    legs = legs.select("id", "perm", "leg", F.size("stops").alias("n"), "source", F.get("stops", F.col("leg") + 1).alias("goal"))
    direct = q.select("id", F.explode("others").alias("source"), F.col("answer").alias("goal"))
    short = scratch.cut(bounded_paths(adj, legs.select("id", "source", "goal").unionByName(direct), 2, 5))
    best = short.where("rank = 1").select("id", "source", "goal", "path")
    chains = legs.join(best, ["id", "source", "goal"]).groupBy("id", "perm", "n").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("leg", "path"))), lambda x: x["path"])).alias("path"), F.count("*").alias("legs")).where("legs = n - 1")
    waypoint = _capped(chains.select("id", "path", "perm"), ["perm"], cap)
    position = F.array_position("others", F.col("source")).alias("pos")
    fallback = _capped(short.join(q.where("seeded"), "id").where("goal = answer and array_contains(others, source)").select("id", "path", position, "rank"), ["pos", "rank"], cap)
    early = q.join(waypoint.withColumnRenamed("paths", "w"), "id", "left").join(fallback.withColumnRenamed("paths", "f"), "id", "left")
    none = F.array().cast("array<array<string>>")
    early = early.select("id", "answer", "others", F.when(F.col("seeded"), 0).when(F.col("w").isNotNull(), 1).alias("strategy"), F.when(F.col("seeded"), F.coalesce("w", "f", none)).otherwise(F.col("w")).alias("paths"))
    early = scratch.cut(early)
    rest = early.where("strategy is null").select("id", "answer", "others")
    far = bounded_paths(adj, rest.select("id", F.explode("others").alias("source"), F.col("answer").alias("goal")), 4, cap)
    direct_paths = _capped(far.join(rest, "id").select("id", "path", position, "rank"), ["pos", "rank"], cap)
    late = rest.join(direct_paths, "id", "left").select("id", F.when(F.col("paths").isNotNull(), 2).otherwise(3).alias("strategy"), F.coalesce("paths", none).alias("paths"))
    return early.where("strategy is not null").select("id", "strategy", "paths").unionByName(late)


def difficulty(strategy: Column) -> Column:
    """The difficulty that a strategy stands for."""
    return F.element_at(F.create_map(*(F.lit(x) for pair in ((0, "entity_selection"), (1, "traversal"), (2, "traversal"), (3, "no_path")) for x in pair)), strategy)
