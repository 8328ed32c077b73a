"""Property graphs: edges from nodes, ontology-driven expansion, closure, links, contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch
from .dewey import dewey_table


def node_edges(graphs: DataFrame) -> DataFrame:
    """``id, section, node_ord, source, type, val_ord, target`` from the nodes' props (section 0) and extra props (1); blank values are none."""
    out = None
    for section, field in enumerate(("props", "extra_props")):
        carry = {"nodes[]": {"node_ord": lambda v, k: F.col("__p"), "source": lambda v, k: v["qid"]}, f"nodes[].{field}{{}}": {"type": lambda v, k: k}, f"nodes[].{field}{{}}[]": {"target": lambda v, k: F.trim(v)}}
        t = dewey_table(graphs, ["id"], "nodes", f"nodes[].{field}{{}}[]", carry)
        t = t.select("id", F.lit(section).alias("section"), "node_ord", "source", "type", F.col("ordinal").alias("val_ord"), "target").where("target <> ''")
        out = t if out is None else out.unionByName(t)
    return out


def local_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose target is a node of the same graph."""
    return edges.join(nodes.select("id", F.col("qid").alias("target")).distinct(), ["id", "target"], "left_semi")


def merged_relations(configs: DataFrame, relations: DataFrame) -> DataFrame:
    """``key, pid, domain, range, pos``: of each configuration's ontologies in order, the first relation of every (pid, domain).

    ``configs`` has ``key, ont_id, ont_pos``; ``relations`` has ``ont_id, rel_pos, pid, domain, range``.
    Ontologies are small; whether they are broadcast is left to their measured size.
    """
    at = F.struct("ont_pos", "rel_pos")
    picked = configs.join(relations, "ont_id").groupBy("key", "pid", "domain").agg(F.min_by(F.struct("range"), at).alias("r"), F.min(at).alias("pos"))
    return picked.select("key", "pid", "domain", F.col("r.range").alias("range"), "pos")


def expand_by_relations(seeds: DataFrame, merged: DataFrame, claims: DataFrame, classes: DataFrame) -> DataFrame:
    """``key, qid, pid, target``: the claims of seeds that their classes' relations allow.

    ``seeds`` has ``key, qid``; ``claims`` has ``qid, pid, target``; ``classes`` has ``qid, class``
    (instances and subclasses).  A relation takes targets that are in its range or have a
    class there; an empty range takes all.  Of several relations of one property, the
    last one that takes any target counts alone.
    """
    own = seeds.join(classes, "qid").join(merged, (F.col("class") == F.col("domain")) & (seeds["key"] == merged["key"])).select(seeds["key"], "qid", "pid", "range", "pos").distinct()
    wide = own.join(claims, ["qid", "pid"])
    kinds = classes.select(F.col("qid").alias("target"), F.col("class").alias("kind")).unionByName(claims.select("target", F.col("target").alias("kind")).distinct())
    free = wide.where("size(range) = 0")
    bound = wide.where("size(range) > 0").select("key", "qid", "pid", "pos", "target", F.explode("range").alias("kind")).join(kinds.distinct(), ["target", "kind"], "left_semi")
    taken = free.select("key", "qid", "pid", "pos", "target").unionByName(bound.select("key", "qid", "pid", "pos", "target")).distinct()
    last = taken.groupBy("key", "qid", "pid").agg(F.max("pos").alias("pos"))
    return taken.join(last, ["key", "qid", "pid", "pos"]).select("key", "qid", "pid", "target")


def build_edges(entities: DataFrame, merged: DataFrame, follow: DataFrame, concepts: DataFrame, claims: DataFrame, classes: DataFrame, known: DataFrame) -> DataFrame:
    """``id, section, source, type, target``, distinct: the edges of the graph of each question.

    ``entities`` has ``id, key, qid, classes`` (``key`` names a list of ontologies), ``merged``
    their relations, ``follow`` has ``key, class, pid`` of the concepts to extend, ``concepts``
    ``key, class``, and ``known`` the ``target``s that are nodes.  An entity with a listed class
    in the domain of a relation gives the claims that the relations allow, and its neighbours
    what their concepts follow (section ``extra_props``); any other gives all its claims.  TYPE
    edges lead to listed classes that are concepts of the ontologies.
    """
    listed = entities.select("id", "key", "qid", F.explode("classes").alias("class"))
    gated = listed.join(merged.select("key", F.col("domain").alias("class")).distinct(), ["key", "class"], "left_semi").select("id", "key", "qid").distinct()
    plain = entities.select("id", "qid").distinct().join(gated.select("id", "qid"), ["id", "qid"], "left_anti")
    allowed = expand_by_relations(gated.select("key", "qid").distinct(), merged, claims, classes)
    own = gated.join(allowed, ["key", "qid"]).join(known, "target", "left_semi")
    every = plain.join(claims, "qid").join(known, "target", "left_semi")
    near = own.select("id", "key", F.col("target").alias("qid")).distinct()
    steps = near.join(classes, "qid").join(follow, ["key", "class"]).select("id", "qid", "pid").distinct()
    extra = steps.join(claims, ["qid", "pid"]).join(known, "target", "left_semi")
    kinds = listed.join(concepts, ["key", "class"], "left_semi")
    edge = lambda df, section: df.select("id", F.lit(section).alias("section"), F.col("qid").alias("source"), F.col("pid").alias("type"), "target")
    typed = kinds.select("id", F.lit("TYPE").alias("section"), F.col("qid").alias("source"), F.lit("TYPE").alias("type"), F.col("class").alias("target"))
    return edge(own, "props").unionByName(edge(every, "props")).unionByName(edge(extra, "extra_props")).unionByName(typed).distinct()


def built_nodes(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """``id, qid``: the entities and all targets of edges that are no TYPE edges."""
    return entities.select("id", "qid").unionByName(edges.where("section <> 'TYPE'").select("id", F.col("target").alias("qid"))).distinct()


def merged_nodes(versions: DataFrame) -> DataFrame:
    """One row per ``qid``: the first label and description by ``at`` that are not empty, and the sorted union of classes.

    Aggregates combine map-side, so a node in a third of all graphs is no hot spot; a
    node's distinct classes are few.
    """
    text = lambda c: F.min_by(F.when(F.col(c) != "", F.col(c)), F.when(F.col(c) != "", F.col("at"))).alias(c)
    lists = lambda c: F.array_sort(F.array_compact(F.array_distinct(F.flatten(F.collect_set(F.coalesce(c, F.array().cast("array<string>"))))))).alias(c)
    return versions.groupBy("qid").agg(text("label"), text("description"), lists("instance_of"), lists("subclass_of"))


def merged_props(versions: DataFrame) -> DataFrame:
    """Distinct ``qid, field, pid, target`` over all versions; blank values are none."""
    out = None
    for field in ("props", "extra_props"):
        each = versions.select("qid", F.lit(field).alias("field"), F.explode(field).alias("pid", "values")).select("qid", "field", "pid", F.explode("values").alias("target"))
        each = each.withColumn("target", F.trim("target")).where("target <> ''")
        out = each if out is None else out.unionByName(each)
    return out.distinct()


def closure(members: DataFrame, claims: DataFrame, rounds: int | None = None) -> DataFrame:
    """``id, qid, depth``: the members of each graph and the entities that they refer to, directly or through others, until nothing is added or up to ``rounds`` steps.

    Each round joins only what the last one added, and is cut from its lineage.
    """
    scratch = Scratch(members.sparkSession, "closure")
    steps = scratch.cut(claims.select("qid", "target").distinct())
    every = front = scratch.cut(members.select("id", "qid").distinct().withColumn("depth", F.lit(0)))
    depth = 0
    while depth != rounds and not front.isEmpty():
        depth += 1
        front = scratch.cut(front.join(steps, "qid").select("id", F.col("target").alias("qid")).distinct().join(every.select("id", "qid"), ["id", "qid"], "left_anti").withColumn("depth", F.lit(depth)))
        every = every.unionByName(front)
    return every


def one_hop_links(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """``id, a, b, direction, type`` of the first direct link of each pair: forward before inverse, then by type."""
    e = edges.select("source", "target", "type").distinct()
    forward = pairs.join(e, (F.col("a") == F.col("source")) & (F.col("b") == F.col("target"))).select("id", "a", "b", F.lit(0).alias("direction"), "type")
    inverse = pairs.join(e, (F.col("b") == F.col("source")) & (F.col("a") == F.col("target"))).select("id", "a", "b", F.lit(1).alias("direction"), "type")
    return forward.unionByName(inverse).groupBy("id", "a", "b").agg(F.min(F.struct("direction", "type")).alias("m")).select("id", "a", "b", "m.direction", "m.type")


def two_hop_links(pairs: DataFrame, edges: DataFrame, limit: int = 3) -> DataFrame:
    """``id, a, b, direction, p1, x, p2, rank``: up to ``limit`` links over one entity between, by (p1, x, p2).

    Direction 0 leads from a to b; only where no such link exists, direction 1 leads from b to a.
    The second hop is joined on both of its ends, so no hub is ever spread out.
    """
    e = edges.select("source", "target", "type").distinct()
    ways = pairs.select("id", "a", "b", F.lit(0).alias("direction"), F.col("a").alias("start"), F.col("b").alias("end")).unionByName(pairs.select("id", "a", "b", F.lit(1).alias("direction"), F.col("b").alias("start"), F.col("a").alias("end")))
    first = ways.join(e, F.col("start") == F.col("source")).select("id", "a", "b", "direction", "end", F.col("type").alias("p1"), F.col("target").alias("x")).where("x <> a and x <> b")
    second = e.select(F.col("source").alias("x"), F.col("target").alias("end"), F.col("type").alias("p2"))
    pair = Window.partitionBy("id", "a", "b")
    ranked = first.join(second, ["x", "end"]).select("id", "a", "b", "direction", "p1", "x", "p2").distinct().withColumn("rank", F.row_number().over(pair.orderBy("direction", "p1", "x", "p2"))).where(F.col("rank") <= limit)
    # Forward links rank first, so the least direction among those kept is the pair's.
    return ranked.withColumn("own", F.min("direction").over(pair)).where("direction = own").drop("own")


def link_edges(one_hop: DataFrame, two_hop: DataFrame) -> DataFrame:
    """``id, source, type, target``: the edge of each one-hop link, and both edges of the first two-hop link of pairs without one."""
    forward = F.col("direction") == 0
    start, end = F.when(forward, F.col("a")).otherwise(F.col("b")), F.when(forward, F.col("b")).otherwise(F.col("a"))
    near = one_hop.select("id", start.alias("source"), "type", end.alias("target"))
    far = two_hop.where("rank = 1").join(one_hop.select("id", "a", "b"), ["id", "a", "b"], "left_anti")
    both = F.array(F.struct(start.alias("source"), F.col("p1").alias("type"), F.col("x").alias("target")), F.struct(F.col("x").alias("source"), F.col("p2").alias("type"), end.alias("target")))
    return near.unionByName(far.select("id", F.explode(both).alias("e")).select("id", "e.source", "e.type", "e.target")).distinct()


def bridge_paths(pairs: DataFrame, one_hop: DataFrame, two_hop: DataFrame) -> DataFrame:
    """``id, kind, length, triples``: the supporting path that links each pair, by one hop, else by the first way of two."""
    forward = F.col("direction") == 0
    start, end = F.when(forward, F.col("a")).otherwise(F.col("b")), F.when(forward, F.col("b")).otherwise(F.col("a"))
    near = one_hop.select("id", F.lit("1hop").alias("kind"), F.lit(1).alias("length"), F.array(F.array(start, F.col("type"), end)).alias("triples"))
    far = two_hop.where("rank = 1").join(one_hop.select("id"), "id", "left_anti")
    far = far.select("id", F.lit("2hop").alias("kind"), F.lit(2).alias("length"), F.array(F.array(start, F.col("p1"), F.col("x")), F.array(F.col("x"), F.col("p2"), end)).alias("triples"))
    return near.unionByName(far).join(pairs.select("id").distinct(), "id", "left_semi")


def called_nodes() -> Column:
    """The nodes that a question's context is about: those of its shortest path, or its seeds."""
    best = F.array_min(F.transform("supporting_paths", lambda p, i: F.struct(p["length"].alias("length"), i.alias("i"))))
    triples = F.get("supporting_paths", best["i"])["triples"]
    on_path = F.array_distinct(F.flatten(F.transform(triples, lambda t: F.array(F.get(t, F.lit(0)), F.get(t, F.lit(2))))))
    has = F.coalesce(F.size("supporting_paths") > 0, F.lit(False))
    return F.when(F.col("difficulty").isin("traversal", "entity_selection") & has, on_path).when(F.col("difficulty").isin("entity_selection", "property_comparison"), F.col("seeds"))


def neighbourhood_text(called: DataFrame, edges: DataFrame, labels: DataFrame, relation_labels: DataFrame) -> DataFrame:
    """``id, context``: the edges around each called node as lines, outgoing first; an edge between two called nodes is told once.

    ``called`` has ``id, pos, qid``; ``edges`` has ``id, ord, source, type, target``; ``labels``
    has ``qid, label`` and ``relation_labels`` ``pid, label``; without one the id is shown.
    """
    nodes = called.select("id", "pos", "qid")
    e = edges.select("id", "ord", "source", "type", "target")
    outgoing = nodes.join(e, (nodes["id"] == e["id"]) & (nodes["qid"] == e["source"])).select(nodes["id"], "pos", "qid", F.lit(0).alias("way"), "ord", "type", "source", "target", F.col("target").alias("other"))
    incoming = nodes.join(e, (nodes["id"] == e["id"]) & (nodes["qid"] == e["target"])).select(nodes["id"], "pos", "qid", F.lit(1).alias("way"), "ord", "type", "source", "target", F.col("source").alias("other"))
    incoming = incoming.join(nodes.select("id", F.col("qid").alias("source")).distinct(), ["id", "source"], "left_anti")
    told = outgoing.unionByName(incoming).groupBy("id", "pos", "qid", "way", "type", "source", "target", "other").agg(F.min("ord").alias("ord"))
    names = labels.select(F.col("qid").alias("__q"), F.col("label").alias("__l"))
    told = told.join(names, told["other"] == F.col("__q"), "left").withColumn("other_label", F.coalesce("__l", "other")).drop("__q", "__l")
    told = told.join(names, told["qid"] == F.col("__q"), "left").withColumn("label", F.coalesce("__l", "qid")).drop("__q", "__l")
    told = told.join(relation_labels.select(F.col("pid").alias("type"), F.col("label").alias("__r")), "type", "left")
    relation = F.when(F.col("type") == "TYPE", "instance of").otherwise(F.coalesce("__r", "type"))
    line = F.when(F.col("way") == 0, F.concat(F.lit("  --["), relation, F.lit("]--> "), "other_label")).otherwise(F.concat(F.lit("  <--["), relation, F.lit("]-- "), "other_label"))
    per_node = told.groupBy("id", "pos", "label").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("way", "ord", "type", "source", "target", line.alias("line")))), lambda x: x["line"]), "\n").alias("lines"))
    return per_node.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "label", "lines"))), lambda x: F.concat(F.lit("Entity: "), x["label"], F.lit("\n"), x["lines"])), "\n").alias("context"))
