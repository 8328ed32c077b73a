"""Queries over graphs and ontologies, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import answers, graphs, paths, rows
from ..operators.components import connected_components
from .kgqa import REC, WORDS, records, t


def graph(spark: SparkSession, d: str) -> DataFrame:
    """The subgraph of each id: the patched one where there is one."""
    return rows.last_rows(t(spark, d, "subgraph").withColumn("late", (F.col("stage") == "patched").cast("int")), ["id"], ["late", "built_at"], ["nodes", "edges"])


def nodes(spark: SparkSession, d: str) -> DataFrame:
    g = graph(spark, d).select("id", F.posexplode("nodes").alias("node_ord", "n"))
    return g.select("id", "node_ord", *(F.col(f"n.{c}").alias(c) for c in ("qid", "label", "description", "instance_of", "subclass_of")))


def edges(spark: SparkSession, d: str) -> DataFrame:
    g = graph(spark, d).select("id", F.posexplode("edges").alias("ord", "e"))
    return g.select("id", "ord", "e.source", "e.type", "e.target")


def claims(spark: SparkSession, d: str) -> DataFrame:
    g = t(spark, d, "graph_edge").select(F.trim("source").alias("qid"), F.trim("type").alias("pid"), F.trim("target").alias("target"))
    return g.where("qid <> '' and pid <> '' and target <> ''").distinct()


def classes(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "graph_node")
    return n.select("qid", F.explode(F.concat(F.coalesce("instance_of", F.array().cast("array<string>")), F.coalesce("subclass_of", F.array().cast("array<string>")))).alias("class")).distinct()


def seeds(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    ids = F.array_distinct(F.filter(F.transform("entity_qids", T.strip), lambda q: q != ""))
    return records(spark, d, "entity_qids", "answer_node_qid", *cols).withColumns({"seeds": ids, "answer": F.trim("answer_node_qid")})


def relations(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "ontology").select(F.col("id").alias("ont_id"), F.posexplode("relations").alias("rel_pos", "r"))
    return o.select("ont_id", "rel_pos", "r.pid", "r.domain", F.coalesce("r.range", F.array().cast("array<string>")).alias("range"), "r.label")


def configs(spark: SparkSession, d: str) -> DataFrame:
    """Distinct lists of matched ontologies, as a key and their places."""
    keys = records(spark, d, "matched_ontologies").select(F.array_join("matched_ontologies.ont_id", "|").alias("key")).where("key <> ''").distinct()
    return keys.select("key", F.posexplode(F.split("key", r"\|")).alias("ont_pos", "ont_id"))


def ontology_match(spark: SparkSession, d: str) -> DataFrame:
    """The concepts of each ontology among a record's entity ids and their classes."""
    e = records(spark, d, "entities").select("id", F.explode("entities").alias("e"))
    ids = e.select("id", F.explode(F.concat(F.array("e.qid"), F.coalesce("e.classes", F.array().cast("array<string>")))).alias("qid")).where("qid is not null").distinct()
    concepts = t(spark, d, "ontology").select(F.col("id").alias("ont_id"), F.explode("concepts.qid").alias("qid")).where("qid like 'Q%'").distinct()
    return ids.join(concepts, "qid").groupBy("id", "ont_id").agg(F.array_join(F.array_sort(F.collect_set("qid")), "|").alias("matched"))


def ontology_merge(spark: SparkSession, d: str) -> DataFrame:
    return graphs.merged_relations(configs(spark, d), relations(spark, d)).select("key", "pid", "domain", F.array_join("range", "|").alias("range"))


def edges_from_relations(spark: SparkSession, d: str) -> DataFrame:
    return graphs.local_edges(graphs.node_edges(graph(spark, d)), nodes(spark, d))


def type_edges(spark: SparkSession, d: str) -> DataFrame:
    """One edge per entity mention and listed class that is a concept of the record's ontologies; mentions repeat."""
    rec = records(spark, d, "entities", "matched_ontologies")
    concepts = t(spark, d, "ontology").select(F.col("id").alias("ont_id"), F.explode("concepts.qid").alias("class"))
    allowed = rec.select("id", F.explode("matched_ontologies.ont_id").alias("ont_id")).join(concepts, "ont_id").select("id", "class").distinct()
    e = rec.select("id", F.explode("entities").alias("e")).where("e.qid is not null").select("id", F.col("e.qid").alias("source"), F.explode("e.classes").alias("class"))
    return e.join(allowed, ["id", "class"]).select("id", "source", F.lit("TYPE").alias("type"), F.col("class").alias("target"))


def adjacency(spark: SparkSession, d: str) -> DataFrame:
    listed = edges(spark, d).select("id", "source", "type", "target", F.struct(F.lit(0).alias("section"), F.col("ord").alias("o1"), F.lit("").alias("pid"), F.lit(0).alias("o2")).alias("ords"))
    extra = graphs.node_edges(graph(spark, d)).where("section = 1").select("id", "source", "type", "target", F.struct(F.lit(1).alias("section"), F.col("node_ord").alias("o1"), F.col("type").alias("pid"), F.col("val_ord").alias("o2")).alias("ords"))
    return paths.adjacency(listed.unionByName(extra))


def adjacency_multi(spark: SparkSession, d: str) -> DataFrame:
    return adjacency(spark, d)


def expand_1hop(spark: SparkSession, d: str) -> DataFrame:
    """All claims of all seeds."""
    ids = seeds(spark, d).select(F.explode("seeds").alias("qid")).distinct()
    return claims(spark, d).join(ids, "qid", "left_semi")


def _expanded(spark: SparkSession, d: str) -> DataFrame:
    rec = seeds(spark, d, "matched_ontologies").select(F.array_join("matched_ontologies.ont_id", "|").alias("key"), F.explode("seeds").alias("qid")).where("key <> ''").distinct()
    return graphs.expand_by_relations(rec, graphs.merged_relations(configs(spark, d), relations(spark, d)), claims(spark, d), classes(spark, d))


def expand_ontology(spark: SparkSession, d: str) -> DataFrame:
    return _expanded(spark, d)


def expand_concepts(spark: SparkSession, d: str) -> DataFrame:
    """The claims that neighbours of the seeds give by the properties to follow for their classes."""
    follow = t(spark, d, "ontology").select(F.col("id").alias("ont_id"), F.explode("concepts_to_extend").alias("c")).select("ont_id", F.col("c.qid").alias("class"), F.explode("c.follow_pids").alias("pid"))
    allowed = configs(spark, d).join(follow, "ont_id").select("key", "class", "pid").distinct()
    near = _expanded(spark, d).select("key", F.col("target").alias("qid")).distinct()
    steps = near.join(classes(spark, d), "qid").join(allowed, ["key", "class"]).select("key", "qid", "pid").distinct()
    return steps.join(claims(spark, d), ["qid", "pid"]).select("key", "qid", "pid", "target")


def closure_missing(spark: SparkSession, d: str) -> DataFrame:
    """Entities that each graph refers to, directly or through others, and that it has no node for."""
    known = t(spark, d, "graph_node").select(F.col("qid").alias("target")).distinct()
    reached = graphs.closure(nodes(spark, d).select("id", "qid"), claims(spark, d).join(known, "target", "left_semi"))
    return reached.where("depth > 0")


def _components(spark: SparkSession, d: str) -> DataFrame:
    e = edges(spark, d).select(F.concat_ws("|", "id", F.trim("source")).alias("a"), F.concat_ws("|", "id", F.trim("target")).alias("b"))
    c = connected_components(e)
    return c.select(F.substring_index("node", "|", 1).alias("id"), F.substring_index("node", "|", -1).alias("qid"), F.substring_index("component", "|", -1).alias("component"))


def components(spark: SparkSession, d: str) -> DataFrame:
    return _components(spark, d)


def seeds_connected(spark: SparkSession, d: str) -> DataFrame:
    """Whether all seeds of a record lie in one component of its graph."""
    each = seeds(spark, d).select("id", F.explode("seeds").alias("qid")).join(_components(spark, d), ["id", "qid"], "left")
    return each.groupBy("id").agg((F.countDistinct("component") == 1).alias("one"), F.count_if(F.col("component").isNull()).alias("outside")).select("id", (F.col("one") & (F.col("outside") == 0)).alias("connected"))


def _questions(spark: SparkSession, d: str) -> DataFrame:
    return seeds(spark, d, "reasoning_type").where("reasoning_type = 'bridge' and answer <> '' and size(seeds) > 0").select("id", "seeds", "answer")


def paths_bounded(spark: SparkSession, d: str) -> DataFrame:
    starts = _questions(spark, d).select("id", F.explode("seeds").alias("source"), F.col("answer").alias("goal"))
    return paths.bounded_paths(adjacency(spark, d), starts, 4, 20).select("id", "source", "goal", "len", F.array_join("path", " ").alias("path"), "rank")


def path_annotation(spark: SparkSession, d: str) -> DataFrame:
    """Strategy, difficulty and paths of every bridge question."""
    found = paths.annotate_paths(_questions(spark, d), adjacency(spark, d))
    return found.select("id", "strategy", paths.difficulty(F.col("strategy")).alias("difficulty"), F.size("paths").alias("n_paths"), F.array_join(F.transform("paths", lambda p: F.array_join(p, " ")), " ; ").alias("paths"))


def strategy_counts(spark: SparkSession, d: str) -> DataFrame:
    return path_annotation(spark, d).groupBy("strategy", "difficulty").agg(F.count("*").alias("n"), F.count_if(F.col("n_paths") > 0).alias("with_path"))


def comparison_dump(spark: SparkSession, d: str) -> DataFrame:
    """The first edges of each seed of comparison questions; a seed without edges gives an empty text."""
    s = seeds(spark, d, "reasoning_type").where("reasoning_type = 'comparison'").select("id", F.explode("seeds").alias("source"))
    out = s.join(adjacency(spark, d), ["id", "source"], "left").groupBy("id", "source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("adj_ord").isNotNull(), F.struct("adj_ord", F.concat_ws("|", "source", "type", "target").alias("t"))))), lambda x: x["t"]), " ").alias("triples"))
    return out.withColumnRenamed("source", "qid")


def _link_pairs(spark: SparkSession, d: str) -> DataFrame:
    q = seeds(spark, d, "strategy_used", "supporting_paths").where("strategy_used = 0 and coalesce(size(supporting_paths), 0) <= 0 and array_contains(seeds, answer)")
    return q.select("id", F.get(F.filter("seeds", lambda s: s != F.col("answer")), F.lit(0)).alias("a"), F.col("answer").alias("b")).where("a is not null")


def _kg(spark: SparkSession, d: str) -> DataFrame:
    return claims(spark, d).select(F.col("qid").alias("source"), "target", F.col("pid").alias("type"))


def link_1hop(spark: SparkSession, d: str) -> DataFrame:
    return graphs.one_hop_links(_link_pairs(spark, d), _kg(spark, d))


def link_2hop(spark: SparkSession, d: str) -> DataFrame:
    return graphs.two_hop_links(_link_pairs(spark, d), _kg(spark, d))


def edge_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Link edges that a graph does not hold yet: of one-hop links, else both of the first two-hop link."""
    new = graphs.link_edges(link_1hop(spark, d), link_2hop(spark, d))
    return new.join(edges(spark, d).select("id", "source", "type", "target"), ["id", "source", "type", "target"], "left_anti")


def tier3_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Similar nodes of questions without an equal one, the best first."""
    tiers = answers.node_tiers(records(spark, d, "answer"), nodes(spark, d))
    open_ = tiers.groupBy("id").agg(F.min("tier").alias("best")).where("best = 3").select("id")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "node_ord"))
    return tiers.join(open_, "id", "left_semi").select("id", "qid", "node_ord", "score", rank.alias("rank"))


def answer_tiers(spark: SparkSession, d: str) -> DataFrame:
    return answers.answer_nodes(records(spark, d, "answer"), nodes(spark, d))


def answer_routes(spark: SparkSession, d: str) -> DataFrame:
    """Where each question goes: found, tier3, no_match or no_subgraph, counted."""
    has = graph(spark, d).select("id", F.lit(1).alias("has"))
    r = answer_tiers(spark, d).join(has, "id", "left")
    route = F.when(F.col("has").isNull(), "no_subgraph").when(F.col("tier") <= 2, "found").when(F.col("tier") == 3, "tier3").otherwise("no_match")
    return r.groupBy(route.alias("route")).agg(F.count("*").alias("n"))


def unknown_ids(spark: SparkSession, d: str) -> DataFrame:
    """Properties, classes and entities in use that nothing names."""
    pids = claims(spark, d).select(F.col("pid").alias("id")).distinct().join(relations(spark, d).select(F.col("pid").alias("id")), "id", "left_anti").withColumn("kind", F.lit("pid"))
    concepts = t(spark, d, "ontology").select(F.explode("concepts.qid").alias("id"))
    kinds = classes(spark, d).select(F.col("class").alias("id")).distinct().join(concepts, "id", "left_anti").withColumn("kind", F.lit("class"))
    named = t(spark, d, "graph_node").where("trim(label) <> ''").select(F.col("qid").alias("id"))
    entities = claims(spark, d).select(F.col("target").alias("id")).distinct().join(named, "id", "left_anti").withColumn("kind", F.lit("entity"))
    return pids.unionByName(kinds).unionByName(entities).select("kind", "id")


def _labels(spark: SparkSession, d: str) -> DataFrame:
    own = t(spark, d, "graph_node").select("qid", "label")
    concepts = t(spark, d, "ontology").select(F.explode("concepts").alias("c")).select("c.qid", "c.label")
    return rows.first_label([own, concepts])


def label_resolve(spark: SparkSession, d: str) -> DataFrame:
    return _labels(spark, d)


def context_text(spark: SparkSession, d: str) -> DataFrame:
    """The serialised graph context of each question."""
    rec = seeds(spark, d, "difficulty", "supporting_paths")
    called = rec.select("id", F.posexplode(graphs.called_nodes()).alias("pos", "qid")).where("qid is not null")
    names = rows.first_rows(relations(spark, d), "pid", ["ont_id", "rel_pos"], ["label"])
    return graphs.neighbourhood_text(called, edges(spark, d), _labels(spark, d), names)


def title_links(spark: SparkSession, d: str) -> DataFrame:
    """Entity titles looked up as labels: exactly, else in match form; unresolved ones keep a null id."""
    titles = records(spark, d, "entities").select(F.explode("entities.title").alias("title")).where("title is not null").distinct()
    n = t(spark, d, "graph_node").where("label is not null").select("qid", "label")
    exact = n.groupBy(F.col("label").alias("title")).agg(F.min("qid").alias("exact"))
    near = n.select("qid", T.match_form(F.col("label")).alias("form")).where("form <> ''").groupBy("form").agg(F.min("qid").alias("near"))
    out = titles.withColumn("form", T.match_form(F.col("title"))).join(exact, "title", "left").join(near, "form", "left")
    return out.select("title", F.coalesce("exact", "near").alias("qid"), F.when(F.col("exact").isNotNull(), "title").when(F.col("near").isNotNull(), "form").otherwise("none").alias("how"))


QUERIES = {
    f.__name__: f
    for f in (ontology_match, ontology_merge, edges_from_relations, type_edges, adjacency_multi, expand_1hop, expand_ontology, expand_concepts, closure_missing, components, seeds_connected, paths_bounded, path_annotation, strategy_counts, comparison_dump, link_1hop, link_2hop, edge_upsert, answer_tiers, tier3_candidates, answer_routes, unknown_ids, label_resolve, context_text, title_links)
}

G = "g as (select * exclude (rn) from (select *, row_number() over (partition by id order by (stage = 'patched')::int desc, built_at desc) rn from subgraph) where rn = 1)"
N = "n as (select id, i::int node_ord, nodes[i+1].qid qid, nodes[i+1].label \"label\", nodes[i+1].description description, nodes[i+1].props props, nodes[i+1].extra_props extra from (select id, nodes, unnest(range(len(nodes))) i from g))"
E = "e as (select id, i::int ord, edges[i+1].source source, edges[i+1].type \"type\", edges[i+1].target target from (select id, edges, unnest(range(len(edges))) i from g))"
NE = """ne0 as (select id, 0 section, node_ord, qid source, unnest(map_entries(props)) m from n union all select id, 1, node_ord, qid, unnest(map_entries(extra)) from n),
ne1 as (select id, section, node_ord, source, m.key "type", m.value vs, unnest(range(len(m.value))) k from ne0),
ne as (select id, section, node_ord, source, "type", k::int val_ord, trim(vs[k+1]) target from ne1 where trim(vs[k+1]) <> '')"""
ADJ = """a0 as (select id, trim(source) source, trim("type") "type", trim(target) target, 0 s, ord o1, '' p, 0 o2 from e union all select id, trim(source), trim("type"), trim(target), 1, node_ord, "type", val_ord from ne where section = 1),
adj as (select id, source, "type", target, row_number() over (partition by id, source order by s, o1, p, o2, "type", target)::int adj_ord from a0 where source <> '' and "type" <> '' and target <> '')"""
C = "c as (select distinct trim(source) qid, trim(\"type\") pid, trim(target) target from graph_edge where trim(source) <> '' and trim(\"type\") <> '' and trim(target) <> '')"
CL = "cl as (select distinct qid, unnest(list_concat(coalesce(instance_of, []), coalesce(subclass_of, []))) k from graph_node)"
SD = "sd0 as (select id, entity_qids, unnest(range(len(entity_qids))) i from rec), sd1 as (select id, trim(entity_qids[i+1]) q, min(i) i from sd0 where trim(entity_qids[i+1]) <> '' group by 1, 2), sd as (select id, q, row_number() over (partition by id order by i) - 1 pos from sd1)"
CF = "cf0 as (select distinct array_to_string(list_transform(matched_ontologies, lambda m: m.ont_id), '|') k from rec where len(matched_ontologies) > 0), cf1 as (select k, string_split(k, '|') l from cf0), cf as (select k, l[i+1] ont_id, i ont_pos from (select k, l, unnest(range(len(l))) i from cf1))"
RL = "rl0 as (select id ont_id, relations r, unnest(range(len(relations))) i from ontology), rl as (select ont_id, i rel_pos, r[i+1].pid pid, r[i+1].domain dom, coalesce(r[i+1].range, []) rng, r[i+1].label lab from rl0)"
MG = "mg as (select * from (select k, pid, dom, rng, ont_pos, rel_pos, row_number() over (partition by k, pid, dom order by ont_pos, rel_pos) rn from cf join rl using (ont_id)) where rn = 1)"
EX = """sk as (select distinct array_to_string(list_transform(matched_ontologies, lambda m: m.ont_id), '|') k, sd.q qid from rec join sd using (id) where len(matched_ontologies) > 0),
own as (select distinct sk.k, sk.qid, pid, rng, ont_pos, rel_pos from sk join cl using (qid) join mg on mg.k = sk.k and mg.dom = cl.k),
wide as (select own.*, c.target from own join c using (qid, pid)),
tk as (select distinct k, qid, pid, ont_pos, rel_pos, target from wide w where len(rng) = 0 or list_contains(rng, target) or exists (select 1 from cl where cl.qid = w.target and list_contains(w.rng, cl.k))),
ex as (select k, qid, pid, target from (select *, dense_rank() over (partition by k, qid, pid order by ont_pos desc, rel_pos desc) r from tk) where r = 1)"""
Q = "q as (select id, trim(answer_node_qid) answer from rec where reasoning_type = 'bridge' and trim(answer_node_qid) <> '' and id in (select id from sd))"
CO = """ce as (select distinct id, trim(source) a, trim(target) b from e), sy as (select id, a, b from ce union select id, b, a from ce),
re(id, node, seed) as (select distinct id, a, a from sy union select re.id, sy.b, re.seed from re join sy on sy.id = re.id and sy.a = re.node where re.seed < sy.b),
co as (select id, node qid, min(seed) component from re group by id, node)"""
LP = "lp as (select id, trim(answer_node_qid) b, (select q from sd where sd.id = rec.id and q <> trim(answer_node_qid) order by pos limit 1) a from rec where strategy_used = 0 and coalesce(len(supporting_paths), 0) = 0 and exists (select 1 from sd where sd.id = rec.id and q = trim(answer_node_qid)))"
L1 = "l1 as (select * from (select id, a, b, direction, pid \"type\", row_number() over (partition by id, a, b order by direction, pid) rn from (select id, a, b, 0 direction, pid from lp join c on a = qid and b = target union all select id, a, b, 1, pid from lp join c on b = qid and a = target)) where rn = 1)"
#: Two-hop links in both directions, the inverse ones only where there is no forward one.
L2 = """h0 as (select distinct lp.id, a, b, 0 direction, x.pid p1, x.target x, y.pid p2 from lp join c x on x.qid = a join c y on y.qid = x.target and y.target = b where x.target <> a and x.target <> b),
h1 as (select distinct lp.id, a, b, 1 direction, x.pid p1, x.target x, y.pid p2 from lp join c x on x.qid = b join c y on y.qid = x.target and y.target = a where x.target <> a and x.target <> b),
h2 as (select * from h0 union all select * from h1 where not exists (select 1 from h0 where h0.id = h1.id and h0.a = h1.a and h0.b = h1.b)),
l2 as (select * from (select *, row_number() over (partition by id, a, b order by p1, x, p2)::int rank from h2) where rank <= 3)"""
_m = lambda x: f"array_to_string({WORDS.format(x)}, ' ')"
_fz = lambda x: f"case when least(length(af), length({x}f)) >= 3 and (contains(af, {x}f) or contains({x}f, af)) then 0.5::double + least(length(af), length({x}f))::double / (greatest(length(af), length({x}f)) + 1) when len({x}w) > 0 and len(aw) > 0 and len(list_intersect(aw, {x}w))::double / len(list_distinct(list_concat(aw, {x}w))) >= 0.5 then len(list_intersect(aw, {x}w))::double / len(list_distinct(list_concat(aw, {x}w))) else 0.0::double end"
_ti = lambda x, c: f"case when {c} is null or {c} = '' then 4 when lower(trim(answer, ' ' || chr(9) || chr(10) || chr(160) || chr(12288) || chr(8239) || chr(8199) || chr(8201))) = lower(trim({c}, ' ' || chr(9) || chr(10) || chr(160) || chr(12288) || chr(8239) || chr(8199) || chr(8201))) then 1 when af = {x}f then 2 when {x}s > 0 then 3 else 4 end"
TR = f"""t0 as (select n.id, node_ord, qid, answer, "label", description, {_m('answer')} af, {_m('"label"')} lf, {_m('description')} df, list_distinct({WORDS.format('answer')}) aw, list_distinct({WORDS.format('"label"')}) lw, list_distinct({WORDS.format('description')}) dw from rec join n using (id) where answer is not null),
t1 as (select *, {_fz('l')} ls, {_fz('d')} ds from t0),
t2 as (select *, {_ti('l', '"label"')} lt, {_ti('d', 'description')} dt from t1),
tr as (select id, node_ord, qid, least(lt, dt) tier, case when least(lt, dt) <= 2 then 1.0::double else greatest(case when lt = 3 then ls else 0 end, case when dt = 3 then ds else 0 end) end score from t2 where least(lt, dt) < 4)"""
AT = """a1 as (select id, (select struct_pack(tier := tier, qid := qid) from tr where tr.id = rec.id and tier <= 2 order by node_ord limit 1) x, (select qid from tr where tr.id = rec.id and tier = 3 order by score desc, node_ord limit 1) s, (select count(*) from tr where tr.id = rec.id and tier = 3) k from rec),
ans as (select id, case when x is not null then x.tier when k > 0 then 3 else 4 end tier, case when x is not null then x.qid when k > 0 then s end qid, case when x is not null then 0 else k end candidates from a1)"""
LB = "lb as (select * from (select qid, \"label\", priority, row_number() over (partition by qid order by priority, \"label\") rn from (select qid, label \"label\", 0 priority from graph_node where trim(label) <> '' and qid is not null union all select c.qid, c.label, 1 from (select unnest(concepts) c from ontology) where trim(c.label) <> '')) where rn = 1)"
#: Paths of at most two hops between waypoints, the first five of each pair.
SG = """wp as (select distinct a.id, a.q u, b.q v from sd a join q on q.id = a.id join (select id, q from sd union select id, answer from q) b on b.id = a.id where a.q <> b.q),
sg0 as (select w.id, u, v, 1 len, [x.adj_ord] ords, [u || '|' || x."type" || '|' || v] path from wp w join adj x on x.id = w.id and x.source = u and x.target = v
 union all select w.id, u, v, 2, [x.adj_ord, y.adj_ord], [u || '|' || x."type" || '|' || x.target, y.source || '|' || y."type" || '|' || v] from wp w join adj x on x.id = w.id and x.source = u and x.target <> u and x.target <> v join adj y on y.id = w.id and y.source = x.target and y.target = v),
sg as (select *, row_number() over (partition by id, u, v order by len, ords) r from sg0)"""
#: The search: paths of at most four hops from seeds to answers.
F4 = """fr(id, source, goal, node, seen, ords, path, len) as (
 select distinct q.id, sd.q, q.answer, sd.q, [sd.q], []::int[], []::varchar[], 0 from q join sd using (id) where sd.q <> q.answer
 union all select f.id, f.source, f.goal, a.target, list_append(f.seen, a.target), list_append(f.ords, a.adj_ord), list_append(f.path, f.node || '|' || a."type" || '|' || a.target), f.len + 1
 from fr f join adj a on a.id = f.id and a.source = f.node where f.len < 4 and f.node <> f.goal and not list_contains(f.seen, a.target)),
pb as (select id, source, goal, len, ords, path, row_number() over (partition by id, source, goal order by len, ords) r from fr where node = goal and len > 0)"""
AN = """ot as (select sd.id, sd.q, row_number() over (partition by sd.id order by sd.pos) - 1 pos, count(*) over (partition by sd.id) n from sd join q using (id) where sd.q <> q.answer),
z as (select q.id, answer, exists (select 1 from sd where sd.id = q.id and sd.q = q.answer) seeded, coalesce((select max(n) from ot where ot.id = q.id), 0) n from q),
b1 as (select id, u, v, path from sg where r = 1),
p1 as (select z.id, 0 perm, b.path path from z join ot o on o.id = z.id join b1 b on b.id = z.id and b.u = o.q and b.v = z.answer where z.n = 1),
p2 as (select z.id, o1.pos::int perm, list_concat(b.path, d.path) path from z join ot o1 on o1.id = z.id join ot o2 on o2.id = z.id and o2.pos <> o1.pos join b1 b on b.id = z.id and b.u = o1.q and b.v = o2.q join b1 d on d.id = z.id and d.u = o2.q and d.v = z.answer where z.n = 2 and (not seeded or o1.pos = 0)),
p3 as (select z.id, (o1.pos * 100 + o2.pos * 10 + o3.pos)::int perm, list_concat(list_concat(b.path, d.path), f.path) path from z join ot o1 on o1.id = z.id join ot o2 on o2.id = z.id join ot o3 on o3.id = z.id join b1 b on b.id = z.id and b.u = o1.q and b.v = o2.q join b1 d on d.id = z.id and d.u = o2.q and d.v = o3.q join b1 f on f.id = z.id and f.u = o3.q and f.v = z.answer
 where z.n = 3 and o1.pos <> o2.pos and o1.pos <> o3.pos and o2.pos <> o3.pos and (not seeded or (o1.pos = 0 and o2.pos = 1))),
w0 as (select id, path, min(perm) o from (select * from p1 union all select * from p2 union all select * from p3) group by id, path),
w as (select id, string_agg(array_to_string(path, ' '), ' ; ' order by len(path), o) paths, count(*) k from (select *, row_number() over (partition by id order by len(path), o) r from w0) where r <= 20 group by id),
f0 as (select sg.id, path, min((o.pos, sg.r)) o from sg join z on z.id = sg.id and z.seeded and sg.v = z.answer join ot o on o.id = sg.id and o.q = sg.u where sg.r <= 5 group by sg.id, path),
f as (select id, string_agg(array_to_string(path, ' '), ' ; ' order by len(path), o) paths, count(*) k from (select *, row_number() over (partition by id order by len(path), o) r from f0) where r <= 20 group by id),
d0 as (select pb.id, path, min((o.pos, pb.r)) o from pb join ot o on o.id = pb.id and o.q = pb.source where pb.r <= 20 group by pb.id, path),
d as (select id, string_agg(array_to_string(path, ' '), ' ; ' order by len(path), o) paths, count(*) k from (select *, row_number() over (partition by id order by len(path), o) r from d0) where r <= 20 group by id),
an as (select z.id, case when seeded then 0 when w.id is not null then 1 when d.id is not null then 2 else 3 end strategy,
 coalesce(case when seeded then coalesce(w.paths, f.paths) when w.id is not null then w.paths else d.paths end, '') paths,
 coalesce(case when seeded then coalesce(w.k, f.k) when w.id is not null then w.k else d.k end, 0)::int n_paths from z left join w on w.id = z.id left join f on f.id = z.id left join d on d.id = z.id),
ann as (select id, strategy, case strategy when 0 then 'entity_selection' when 3 then 'no_path' else 'traversal' end difficulty, n_paths, paths from an)"""
_PATHS = f"with recursive {REC}, {G}, {N}, {E}, {NE}, {ADJ}, {SD}, {Q}"

ORACLES = {
    "ontology_match": f"""with {REC}, i as (select id, unnest(entities) e from rec), ids as (select distinct id, unnest(list_concat([e.qid], coalesce(e.classes, []))) q from i),
c as (select distinct id ont_id, unnest(list_transform(concepts, lambda c: c.qid)) q from ontology)
select ids.id, ont_id, string_agg(q, '|' order by q) matched from ids join c using (q) where q like 'Q%' group by ids.id, ont_id""",
    "ontology_merge": f"with {REC}, {CF}, {RL}, {MG} select k \"key\", pid, dom \"domain\", array_to_string(rng, '|') \"range\" from mg",
    "edges_from_relations": f"with {G}, {N}, {NE} select ne.* from ne where exists (select 1 from n where n.id = ne.id and n.qid = ne.target)",
    "type_edges": f"""with {REC}, e as (select id, unnest(entities) e from rec), m as (select id, e.qid source, unnest(e.classes) k from e where e.qid is not null),
o as (select id, unnest(matched_ontologies).ont_id ont_id from rec), c as (select id ont_id, unnest(concepts).qid k from ontology), al as (select distinct o.id, k from o join c using (ont_id))
select m.id, source, 'TYPE' "type", k target from m join al using (id, k)""",
    "adjacency_multi": f"with {G}, {N}, {E}, {NE}, {ADJ} select * from adj",
    "expand_1hop": f"with {REC}, {SD}, {C} select * from c where qid in (select q from sd)",
    "expand_ontology": f"with {REC}, {SD}, {C}, {CL}, {CF}, {RL}, {MG}, {EX} select k \"key\", qid, pid, target from ex",
    "expand_concepts": f"""with {REC}, {SD}, {C}, {CL}, {CF}, {RL}, {MG}, {EX}, f0 as (select id ont_id, unnest(concepts_to_extend) x from ontology), f1 as (select ont_id, x.qid kl, unnest(x.follow_pids) pid from f0),
al as (select distinct cf.k, kl, pid from cf join f1 using (ont_id)), nr as (select distinct k, target qid from ex), st as (select distinct nr.k, nr.qid, al.pid from nr join cl on cl.qid = nr.qid join al on al.k = nr.k and al.kl = cl.k)
select st.k "key", st.qid, st.pid, c.target from st join c using (qid, pid)""",
    "closure_missing": f"""with recursive {G}, {N}, {C}, k as (select distinct qid from graph_node), st as (select distinct qid, target from c where target in (select qid from k)), m as (select distinct id, qid from n),
r(id, qid, depth) using key (id, qid) as (select id, qid, 0 depth from m union select r.id, st.target, min(r.depth) + 1 from r join st using (qid) where not exists (select 1 from recurring.r p where p.id = r.id and p.qid = st.target) group by r.id, st.target)
select id, qid, depth from r where depth > 0""",
    "components": f"with recursive {G}, {E}, {CO} select id, qid, component from co",
    "seeds_connected": f"with recursive {REC}, {G}, {E}, {SD}, {CO} select sd.id, count(distinct component) = 1 and count(*) filter (component is null) = 0 connected from sd left join co on co.id = sd.id and co.qid = sd.q group by sd.id",
    "paths_bounded": f"{_PATHS}, {F4} select id, source, goal, len, array_to_string(path, ' ') path, r::int rank from pb where r <= 20",
    "path_annotation": f"{_PATHS}, {SG}, {F4}, {AN} select * from ann",
    "strategy_counts": f"{_PATHS}, {SG}, {F4}, {AN} select strategy, difficulty, count(*) n, count(*) filter (n_paths > 0) with_path from ann group by all",
    "comparison_dump": f"""with {REC}, {G}, {N}, {E}, {NE}, {ADJ}, {SD} select sd.id, sd.q qid, coalesce(string_agg(a.source || '|' || a."type" || '|' || a.target, ' ' order by adj_ord), '') triples
from sd join rec on rec.id = sd.id and reasoning_type = 'comparison' left join adj a on a.id = sd.id and a.source = sd.q group by sd.id, sd.q""",
    "link_1hop": f"with {REC}, {SD}, {C}, {LP}, {L1} select id, a, b, direction, \"type\" from l1",
    "link_2hop": f"with {REC}, {SD}, {C}, {LP}, {L2} select id, a, b, direction, p1, x, p2, rank from l2",
    "edge_upsert": f"""with {REC}, {SD}, {C}, {LP}, {L1}, {L2}, {G}, {E},
nw as (select id, case when direction = 0 then a else b end source, "type", case when direction = 0 then b else a end target from l1
 union select id, case when direction = 0 then a else b end, p1, x from l2 where rank = 1 and id not in (select id from l1) union select id, x, p2, case when direction = 0 then b else a end from l2 where rank = 1 and id not in (select id from l1))
select * from nw where not exists (select 1 from e where e.id = nw.id and e.source = nw.source and e."type" = nw."type" and e.target = nw.target)""",
    "answer_tiers": f"with {REC}, {G}, {N}, {TR}, {AT} select id, tier, qid, candidates from ans",
    "tier3_candidates": f"with {REC}, {G}, {N}, {TR} select id, qid, node_ord, score, row_number() over (partition by id order by score desc, node_ord)::int rank from tr where id in (select id from tr group by id having min(tier) = 3)",
    "answer_routes": f"with {REC}, {G}, {N}, {TR}, {AT} select case when id not in (select id from g) then 'no_subgraph' when tier <= 2 then 'found' when tier = 3 then 'tier3' else 'no_match' end route, count(*) n from ans group by 1",
    "unknown_ids": f"""with {C}, {CL}, {RL} select 'pid' kind, pid id from (select distinct pid from c where pid not in (select pid from rl))
union all select 'class', k from (select distinct k from cl where k is not null and k not in (select unnest(concepts).qid from ontology)) union all select 'entity', target from (select distinct target from c where target not in (select qid from graph_node where trim(label) <> '' and qid is not null))""",
    "label_resolve": f"with {LB} select qid, \"label\", priority from lb",
    "context_text": f"""with {REC}, {G}, {E}, {SD}, {RL}, {LB},
bp as (select id, difficulty, (select list_filter(list_sort(list_transform(supporting_paths, lambda p, i: (p.length, i))), lambda x: true))[1] m, supporting_paths sp from rec),
pn as (select id, sp[m[2]].triples ts from bp where difficulty in ('traversal', 'entity_selection') and len(sp) > 0),
pt as (select id, ts, unnest(range(len(ts))) i from pn), pq as (select id, 2 * i o, ts[i+1][1] q from pt union all select id, 2 * i + 1, ts[i+1][3] from pt),
pd as (select id, q, min(o) o from pq where q is not null group by id, q),
cn as (select id, row_number() over (partition by id order by o) pos, q qid from pd union all select sd.id, sd.pos, sd.q from sd join rec using (id) where difficulty = 'property_comparison' or (difficulty = 'entity_selection' and coalesce(len(supporting_paths), 0) = 0)),
pl as (select pid, arg_min(lab, (ont_id, rel_pos)) lab from rl group by pid),
tl as (select cn.id, pos, cn.qid, 0 way, "type", source, target, target other, min(ord) ord from cn join e on e.id = cn.id and e.source = cn.qid group by all
 union all select cn.id, pos, cn.qid, 1, "type", source, target, source, min(ord) from cn join e on e.id = cn.id and e.target = cn.qid where not exists (select 1 from cn c2 where c2.id = cn.id and c2.qid = e.source) group by all),
ln as (select tl.id, pos, coalesce(l2."label", tl.qid) lab, way, ord, "type", source, target, (case when way = 0 then '  --[' else '  <--[' end) || (case when "type" = 'TYPE' then 'instance of' else coalesce(pl.lab, "type") end) || (case when way = 0 then ']--> ' else ']-- ' end) || coalesce(l1."label", other) line
 from tl left join lb l1 on l1.qid = other left join lb l2 on l2.qid = tl.qid left join pl on pl.pid = "type"),
nd as (select id, pos, lab, string_agg(line, chr(10) order by way, ord, "type", source, target) lines from ln group by id, pos, lab)
select id, string_agg('Entity: ' || lab || chr(10) || lines, chr(10) order by pos, lab, lines) context from nd group by id""",
    "title_links": f"""with {REC}, t as (select distinct title from (select unnest(entities).title title from rec) where title is not null), ex as (select label title, min(qid) x from graph_node where label is not null group by 1),
nr as (select {_m('label')} form, min(qid) y from graph_node where label is not null group by 1) select t.title, coalesce(x, y) qid, case when x is not null then 'title' when y is not null then 'form' else 'none' end how
from t left join ex using (title) left join nr on nr.form = {_m('t.title')} and nr.form <> ''""",
}
