"""Queries that build, patch and merge whole records and graphs, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import answers, graphs, metrics, rows
from . import graph as g, kgqa
from .graph import AT, C, CF, CL, CO, E, EX, G, L1, L2, LP, MG, N, Q, RL, SD, TR
from .kgqa import REC, SCORED, _scored, records, t

def _none() -> Column:
    return F.array().cast("array<string>")


# building and patching graphs
def _entities(spark: SparkSession, d: str) -> DataFrame:
    rec = records(spark, d, "entities", "matched_ontologies")
    e = rec.select("id", F.coalesce(F.array_join("matched_ontologies.ont_id", "|"), F.lit("")).alias("key"), F.explode("entities").alias("e"))
    return e.select("id", "key", F.col("e.qid").alias("qid"), F.coalesce("e.classes", _none()).alias("classes")).where("qid like 'Q%'")


def _built(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "ontology").select(F.col("id").alias("ont_id"), "concepts", "concepts_to_extend")
    follow = o.select("ont_id", F.explode("concepts_to_extend").alias("c")).select("ont_id", F.col("c.qid").alias("class"), F.explode("c.follow_pids").alias("pid"))
    concepts = o.select("ont_id", F.explode("concepts.qid").alias("class"))
    cf = g.configs(spark, d)
    known = t(spark, d, "graph_node").select(F.col("qid").alias("target")).where("target is not null").distinct()
    return graphs.build_edges(
        _entities(spark, d),
        graphs.merged_relations(cf, g.relations(spark, d)),
        cf.join(follow, "ont_id").select("key", "class", "pid").distinct(),
        cf.join(concepts, "ont_id").select("key", "class").distinct(),
        g.claims(spark, d),
        g.classes(spark, d),
        known,
    )


def build_subgraphs(spark: SparkSession, d: str) -> DataFrame:
    """The edges of the graph of each question, built from its entities, its ontologies and the knowledge graph."""
    return _built(spark, d)


def build_nodes(spark: SparkSession, d: str) -> DataFrame:
    """The nodes of the built graphs with their texts; nodes without one bear their id."""
    ids = graphs.built_nodes(_entities(spark, d), _built(spark, d))
    info = rows.first_rows(t(spark, d, "graph_node"), "qid", ["label", "description"], ["label", "description"])
    return ids.join(info, "qid", "left").select("id", "qid", F.coalesce("label", "qid").alias("label"), F.coalesce("description", F.lit("")).alias("description"))


def build_missing(spark: SparkSession, d: str) -> DataFrame:
    """Built edges of the questions that no stored graph exists for."""
    return _built(spark, d).join(g.graph(spark, d).select("id"), "id", "left_anti")


def _patched(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    members = g.nodes(spark, d).select("id", "qid").where("qid is not null").distinct()
    return members, g.closure_missing(spark, d)


def patched_edges(spark: SparkSession, d: str) -> DataFrame:
    """The edges of the closed graphs: all claims between members, and the stored TYPE edges."""
    members, added = _patched(spark, d)
    every = members.unionByName(added.select("id", "qid"))
    inner = every.join(g.claims(spark, d), "qid").select("id", F.col("qid").alias("source"), F.col("pid").alias("type"), "target")
    inner = inner.join(every.select("id", F.col("qid").alias("target")), ["id", "target"], "left_semi").select("id", "source", "type", "target")
    return inner.unionByName(g.edges(spark, d).where("type = 'TYPE'").select("id", "source", "type", "target")).distinct()


def patch_tally(spark: SparkSession, d: str) -> DataFrame:
    """How many graphs closing them changes, and how many nodes it adds."""
    _, added = _patched(spark, d)
    per = g.graph(spark, d).select("id").join(added.groupBy("id").agg(F.count("*").alias("n")), "id", "left")
    return per.groupBy(F.when(F.col("n") > 0, "patched").otherwise("already_ok").alias("status")).agg(F.count("*").alias("graphs"), F.coalesce(F.sum("n"), F.lit(0)).alias("added"))


def node_merge(spark: SparkSession, d: str) -> DataFrame:
    """One row per node over all its versions: the first label and description that say anything, all classes."""
    return graphs.merged_nodes(_versions(spark, d)).select("qid", "label", "description", F.array_join("instance_of", "|").alias("instance_of"), F.array_join("subclass_of", "|").alias("subclass_of"))


def _versions(spark: SparkSession, d: str) -> DataFrame:
    s = t(spark, d, "subgraph").select("id", "stage", "built_at", F.posexplode("nodes").alias("node_ord", "n"))
    return s.select("id", "stage", "built_at", "node_ord", "n.*").where("qid is not null").withColumn("at", F.struct("id", "stage", "built_at", "node_ord"))


def node_merge_props(spark: SparkSession, d: str) -> DataFrame:
    """All values of all versions of a node, by field and property."""
    return graphs.merged_props(_versions(spark, d))


def entity_fetch(spark: SparkSession, d: str) -> DataFrame:
    """The distinct entities of the records with their texts; ``missing`` where the knowledge graph lacks them."""
    ids = g.seeds(spark, d).select(F.explode("seeds").alias("qid")).distinct()
    info = rows.first_rows(t(spark, d, "graph_node"), "qid", ["label", "description"], ["label", "description"]).withColumn("has", F.lit(True))
    return ids.join(info, "qid", "left").select("qid", "label", "description", F.col("has").isNull().alias("missing"))


def fetch_batches(spark: SparkSession, d: str) -> DataFrame:
    """The entities to fetch in batches of 50, in hash order."""
    ids = g.seeds(spark, d).select(F.explode("seeds").alias("qid")).distinct().withColumn("__md5", F.md5("qid"))
    return rows.rank_by_text(ids, [], "__md5", "qid").select("qid", F.floor((F.col("rank") - 1) / 50).alias("batch"))


def claim_targets(spark: SparkSession, d: str) -> DataFrame:
    """Entity-valued values of the nodes' properties with their places; other values are left out."""
    n = t(spark, d, "graph_node").select("qid", F.explode("props").alias("pid", "values")).select("qid", "pid", F.posexplode("values").alias("ord", "target"))
    return n.withColumn("target", F.trim("target")).where(F.col("target").rlike("^Q[0-9]+$")).distinct()


def paths_exist(spark: SparkSession, d: str) -> DataFrame:
    """Whether any path joins a seed and the answer, whatever its direction; both must have edges."""
    c = g._components(spark, d)
    pairs = g._questions(spark, d).select("id", F.explode("seeds").alias("qid"), "answer")
    a = pairs.join(c, ["id", "qid"], "left").withColumnRenamed("component", "ca")
    b = c.select("id", F.col("qid").alias("answer"), F.col("component").alias("cb"))
    return a.join(b, ["id", "answer"], "left").select("id", F.col("qid").alias("source"), F.col("answer").alias("goal"), F.coalesce(F.col("ca") == F.col("cb"), F.lit(False)).alias("found"))


# bridge patches
def _bridged(spark: SparkSession, d: str) -> DataFrame:
    has = g.graph(spark, d).select("id")
    pairs = g._link_pairs(spark, d).join(has, "id", "left_semi")
    kg = g._kg(spark, d)
    return graphs.bridge_paths(pairs, graphs.one_hop_links(pairs, kg), graphs.two_hop_links(pairs, kg))


def bridge_patch(spark: SparkSession, d: str) -> DataFrame:
    """The supporting path that a link gives to each entity selection without one."""
    return _bridged(spark, d).select("id", "kind", "length", F.array_join(F.transform("triples", lambda x: F.array_join(x, "|")), " ").alias("path"))


def bridge_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes between two hops that their graph lacks, as bare rows: an unknown label is the id, an unknown description empty."""
    between = _bridged(spark, d).where("kind = '2hop'").select("id", F.col("triples")[0][2].alias("qid")).distinct()
    new = between.join(g.nodes(spark, d).select("id", "qid"), ["id", "qid"], "left_anti")
    info = rows.first_rows(t(spark, d, "graph_node"), "qid", ["label", "description"], ["label", "description"])
    return new.join(info, "qid", "left").select("id", "qid", F.coalesce("label", "qid").alias("label"), F.coalesce("description", F.lit("")).alias("description"))


def bridge_tally(spark: SparkSession, d: str) -> DataFrame:
    """What happened to the entity selections."""
    rec = records(spark, d, "difficulty", "supporting_paths", "strategy_used").where("difficulty = 'entity_selection'")
    done = _bridged(spark, d).select("id", "kind")
    tried = g._link_pairs(spark, d).join(g.graph(spark, d).select("id"), "id", "left_semi").select("id", F.lit(1).alias("tried"))
    j = rec.join(done, "id", "left").join(tried, "id", "left")
    how = F.when(F.coalesce(F.size("supporting_paths") > 0, F.lit(False)), "already_has_path").when(F.col("kind").isNotNull(), F.concat(F.lit("patched_"), "kind")).when(F.col("tried").isNotNull(), "not_found").otherwise("skipped")
    return j.groupBy(how.alias("outcome")).agg(F.count("*").alias("n"))


# answers
def _contains(answer: str, label: str) -> bool:
    """A stand-in for a judging model: one text holds the other."""
    return answer in label or label in answer


def _contains_loosely(answer: str, label: str) -> bool:
    return any(w in label for w in answer.split(" ") if len(w) > 3)


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    rec = records(spark, d, "answer")
    named = g.nodes(spark, d).where("qid is not null").groupBy("id", "qid").agg(F.min_by(F.struct("label"), "node_ord").alias("l"))
    c = g.tier3_candidates(spark, d).join(named, ["id", "qid"]).join(rec, "id")
    return c.select("id", "rank", "qid", "answer", F.coalesce(F.when(F.col("l.label") != "", F.col("l.label")), F.col("qid")).alias("label"))


def _routed(spark: SparkSession, d: str) -> DataFrame:
    confirmed = answers.confirmed(answers.judged(_candidates(spark, d), _contains))
    has = g.graph(spark, d).select("id", F.lit(1).alias("has"))
    return answers.routes(g.answer_tiers(spark, d).join(has, "id", "left"), confirmed)


def answer_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Where each question goes and why, with the first candidate that the judge confirms."""
    return _routed(spark, d)


def answer_retry(spark: SparkSession, d: str) -> DataFrame:
    """Questions whose candidates were all declined, judged again more loosely."""
    again = _routed(spark, d).where("reason = 'tier3_declined'").select("id")
    confirmed = answers.confirmed(answers.judged(_candidates(spark, d).join(again, "id", "left_semi"), _contains_loosely))
    return again.join(confirmed, "id", "left").select("id", F.col("qid").alias("qid"), F.when(F.col("qid").isNotNull(), "found").otherwise("not_found").alias("route"))


# records
def merged_records(spark: SparkSession, d: str) -> DataFrame:
    """Records merged with their path annotation, which decides on difficulty, strategy and paths; those without a path are left out."""
    ann = g.path_annotation(spark, d).select("id", F.col("strategy").alias("strategy_used"), "difficulty", "n_paths", "paths")
    found = records(spark, d, "question", "answer", "answer_node_qid", "reasoning_type", "match_tier", "entities", "matched_ontologies")
    j = found.join(ann, "id").where("difficulty is null or difficulty <> 'no_path'")
    return j.select("id", "question", "answer", F.trim("answer_node_qid").alias("answer_node_qid"), F.array_join(F.array("answer"), "|").alias("aliases"), "reasoning_type", "difficulty", "strategy_used", (F.col("n_paths") > 0).alias("path_found"), "match_tier", F.coalesce(F.size("entities"), F.lit(0)).alias("n_entities"), F.coalesce(F.size("matched_ontologies"), F.lit(0)).alias("n_ontologies"), F.when(F.col("reasoning_type") == "comparison", "").otherwise(F.col("paths")).alias("paths"))


def merge_counts(spark: SparkSession, d: str) -> DataFrame:
    """Annotated records, and replies' records that no annotation exists for."""
    ids = t(spark, d, "prediction").select("id").where("id is not null").distinct()
    known = records(spark, d, "split").select("id", F.lit(1).alias("has"))
    return ids.join(known, "id", "left").agg(F.count("*").alias("annotated"), F.count_if(F.col("has").isNull()).alias("unmatched"))


def redirect_links(spark: SparkSession, d: str) -> DataFrame:
    """Titles linked in two passes: by label, and those left over through the titles of documents, which stand in for
    redirects; a redirect brings the canonical title and classes of its node."""
    titles = records(spark, d, "entities").select(F.explode("entities.title").alias("title")).where("title is not null").distinct()
    n = t(spark, d, "graph_node").where("qid is not null")
    first = n.where("label is not null").groupBy(F.col("label").alias("title")).agg(F.min("qid").alias("first"))
    again = t(spark, d, "documents").where("title is not null and trim(qid) <> ''").groupBy("title").agg(F.min(F.trim("qid")).alias("second"))
    info = n.groupBy("qid").agg(F.min("label").alias("canonical"), F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce("instance_of", _none()))))).alias("classes"))
    out = titles.join(first, "title", "left").join(again, "title", "left").withColumn("qid", F.coalesce("first", "second"))
    out = out.join(info, "qid", "left")
    moved = F.col("first").isNull() & (F.trim("canonical") != "")
    return out.select("title", "qid", F.when(moved, F.trim("canonical")).otherwise(F.col("title")).alias("canonical"), F.coalesce(F.array_join("classes", "|"), F.lit("")).alias("classes"))


def label_precedence(spark: SparkSession, d: str) -> DataFrame:
    """Labels of properties and classes: those of ontologies win over cached ones, later ontologies over earlier ones; a label that is the id is none."""
    o = t(spark, d, "ontology")
    relations = o.select(F.col("id").alias("place"), F.posexplode("relations").alias("pos", "x")).select(F.lit("pid").alias("kind"), F.col("x.pid").alias("id"), F.col("x.label").alias("label"), F.struct(F.lit(1), "place", "pos").alias("at"))
    concepts = o.select(F.col("id").alias("place"), F.posexplode("concepts").alias("pos", "x")).select(F.lit("class").alias("kind"), F.col("x.qid").alias("id"), F.col("x.label").alias("label"), F.struct(F.lit(1), "place", "pos").alias("at"))
    cached = t(spark, d, "graph_node").groupBy("qid").agg(F.min(F.when(F.trim("label") != "", F.col("label"))).alias("label")).select(F.lit("class").alias("kind"), F.col("qid").alias("id"), "label", F.struct(F.lit(0), F.lit("").alias("place"), F.lit(0).alias("pos")).alias("at"))
    every = relations.unionByName(concepts).unionByName(cached).withColumn("label", F.trim("label")).where("id is not null and label <> '' and label <> id")
    return every.groupBy("kind", "id").agg(F.max_by("label", "at").alias("label"))


def ontology_counts(spark: SparkSession, d: str) -> DataFrame:
    """In how many ontologies each concept is listed."""
    return t(spark, d, "ontology").select("id", F.explode("concepts.qid").alias("qid")).where("qid is not null").groupBy("qid").agg(F.countDistinct("id").alias("n"))


def comparison_found(spark: SparkSession, d: str) -> DataFrame:
    """Whether any seed of a comparison question has an edge."""
    return g.comparison_dump(spark, d).groupBy("id").agg(F.bool_or(F.col("triples") != "").alias("found"))


# prompts
_SYSTEM = "Give the answer only, in as few words as possible, without any explanation."
#: Worked examples for prompts without and with facts, of our own making.
_SHOTS = [("Which river flows through Vienna?", "Danube"), ("Who painted the Mona Lisa?", "Leonardo da Vinci")]
_FACT_SHOTS = [("Facts:\nEntity: Hamlet\n  --[author]--> William Shakespeare\n\nQuestion: Who wrote Hamlet?", "William Shakespeare")]


def _opening(shots: list[tuple[str, str]]) -> str:
    return "\n".join([f"[system] {_SYSTEM}", *(f"[user] {q}\n[assistant] {a}" for q, a in shots)]) + "\n[user] "


def prompts_few_shot(spark: SparkSession, d: str) -> DataFrame:
    """Closed-book prompts with worked examples."""
    return records(spark, d, "question").select("id", F.concat(F.lit(_opening(_SHOTS)), F.coalesce("question", F.lit(""))).alias("prompt"))


def prompts_oracle(spark: SparkSession, d: str) -> DataFrame:
    """Prompts with the facts of the question's graph; without any facts they are the closed-book ones."""
    j = records(spark, d, "question").join(g.context_text(spark, d), "id", "left")
    question = F.coalesce("question", F.lit(""))
    with_facts = F.concat(F.lit(_opening(_FACT_SHOTS) + "Facts:\n"), "context", F.lit("\n\nQuestion: "), question)
    return j.select("id", F.when(F.coalesce("context", F.lit("")) != "", with_facts).otherwise(F.concat(F.lit(_opening(_SHOTS)), question)).alias("prompt"))


# reports
def context_report(spark: SparkSession, d: str) -> DataFrame:
    """Scores in per cent for the whole, by context type, by difficulty and by reasoning type in one pass."""
    s = _scored(spark, d, ["context_type", "difficulty", "reasoning_type"], ["supporting_paths"])
    r = metrics.metric_report(s, ["context_type", "difficulty", "reasoning_type"])
    return r.select("dimension", "key", (F.col("em") * 100).alias("em"), (F.col("f1") * 100).alias("f1"), "n")


def eval_report(spark: SparkSession, d: str) -> DataFrame:
    """The report as lines, dimensions and keys in order."""
    has = t(spark, d, "prediction").agg(F.coalesce(F.bool_or(F.coalesce(F.col("pred_qid"), F.lit("")) != ""), F.lit(False)).alias("has_qid"))
    dims = ["difficulty", "reasoning_type", "model"]
    return metrics.report_lines(metrics.metric_report(_scored(spark, d, dims), dims, has))


def coverage_top(spark: SparkSession, d: str, k: int = 20) -> DataFrame:
    """The records that lack most links, the worst first. The limit is the report's purpose."""
    return kgqa.coverage_report(spark, d).orderBy(F.desc("missing"), "id").limit(k)


def coverage_join(spark: SparkSession, d: str) -> DataFrame:
    """Bridge records whose raw delivery names more titles than the record links."""
    raw = rows.last_rows(t(spark, d, "split_record").where("id is not null"), ["id"], ["ingested_at", "source"], ["context"]).select("id", F.size(F.array_distinct(F.col("context.title"))).alias("raw_titles"))
    rec = records(spark, d, "entities", "reasoning_type").where("reasoning_type = 'bridge'")
    linked = F.size(F.array_distinct(F.filter(F.coalesce(F.col("entities.qid"), _none()), lambda q: q.isNotNull())))
    return rec.select("id", linked.alias("linked")).join(raw, "id", "left").where("raw_titles > linked")


def demo_sample(spark: SparkSession, d: str, size: int = 25) -> DataFrame:
    """A sample of surely matched records in hash order, those with a waypoint path first."""
    pool = records(spark, d, "match_tier", "strategy_used", "difficulty").where("match_tier = 1")
    return rows.sampled(pool, "id", size, F.coalesce(F.col("strategy_used") == 1, F.lit(False))).select("id", "strategy_used", "difficulty")


def subset_records(spark: SparkSession, d: str) -> DataFrame:
    """The records of a given set of ids: those that the largest model was asked."""
    ids = t(spark, d, "prediction").where("model = 'kgqa_large'").select("id").distinct()
    return records(spark, d, "split", "source").join(ids, "id", "left_semi")


def stamped_documents(spark: SparkSession, d: str) -> DataFrame:
    """The time of each document as ISO text, with its day and hour."""
    at = F.col("fetched_at")
    return t(spark, d, "documents").select("doc_id", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso"), F.to_date(at).alias("day"), F.hour(at).alias("hour"))


def triple_texts(spark: SparkSession, d: str) -> DataFrame:
    """The triples of supporting paths as text."""
    p = records(spark, d, "supporting_paths").select("id", F.posexplode("supporting_paths").alias("path_ord", "p")).select("id", "path_ord", F.posexplode("p.triples").alias("ord", "x"))
    return p.select("id", "path_ord", "ord", T.triple_text(F.get("x", F.lit(0)), F.get("x", F.lit(1)), F.get("x", F.lit(2))).alias("text"))


QUERIES = {
    f.__name__: f
    for f in (
        build_subgraphs, build_nodes, build_missing, patched_edges, patch_tally, node_merge, node_merge_props, entity_fetch, fetch_batches, claim_targets, paths_exist,
        bridge_patch, bridge_nodes, bridge_tally, answer_verdicts, answer_retry, merged_records, merge_counts, redirect_links, label_precedence, ontology_counts,
        comparison_found, prompts_few_shot, prompts_oracle, context_report, eval_report, coverage_top, coverage_join, demo_sample, subset_records, stamped_documents, triple_texts,
    )
}

_EN = """en0 as (select id, coalesce(array_to_string(list_transform(matched_ontologies, lambda m: m.ont_id), '|'), '') k, matched_ontologies mo, entities, unnest(range(len(entities))) i from rec),
en as (select id, k, mo, entities[i+1].qid qid, coalesce(entities[i+1].classes, []) cls from en0 where entities[i+1].qid like 'Q%')"""
_B = f"""{REC}, {C}, {CL}, {CF}, {RL}, {MG}, {_EN},
gt as (select distinct id, k, qid from en where exists (select 1 from mg where mg.k = en.k and list_contains(en.cls, mg.dom))),
pl as (select distinct id, qid from en where not exists (select 1 from gt where gt.id = en.id and gt.qid = en.qid)),
sk as (select distinct k, qid from gt),
{EX[EX.index('own as'):]},
kn as (select distinct qid from graph_node where qid is not null),
p1 as (select distinct gt.id, gt.k, ex.qid s, ex.pid p, ex.target o from gt join ex on ex.k = gt.k and ex.qid = gt.qid where ex.target in (select qid from kn)),
p2 as (select distinct pl.id, c.qid s, c.pid p, c.target o from pl join c using (qid) where c.target in (select qid from kn)),
f0 as (select id ont_id, unnest(concepts_to_extend) x from ontology), f1 as (select ont_id, x.qid kl, unnest(x.follow_pids) pid from f0),
al as (select distinct cf.k, kl, pid from cf join f1 using (ont_id)),
p3 as (select distinct p1.id, p1.o s, al.pid p, c.target o from p1 join cl on cl.qid = p1.o join al on al.k = p1.k and al.kl = cl.k join c on c.qid = p1.o and c.pid = al.pid where c.target in (select qid from kn)),
oc as (select id ont_id, unnest(concepts).qid q from ontology),
p4 as (select distinct en.id, en.qid s, u.q o from en, unnest(en.cls) u(q) where exists (select 1 from oc where oc.q = u.q and list_contains(list_transform(en.mo, lambda m: m.ont_id), oc.ont_id))),
be as (select id, 'props' section, s source, p "type", o target from p1 union select id, 'props', s, p, o from p2 union select id, 'extra_props', s, p, o from p3 union select id, 'TYPE', s, 'TYPE', o from p4)"""
_INFO = "inf as (select * from (select qid, \"label\", description, row_number() over (partition by qid order by \"label\" nulls first, description nulls first) rn from graph_node where qid is not null) where rn = 1)"
_CLOSE = """kq as (select distinct qid from graph_node), st as (select distinct qid, target from c where target in (select qid from kq)), mb as (select distinct id, qid from n where qid is not null),
rc(id, qid) as (select id, qid from mb union select rc.id, st.target from rc join st using (qid))"""
_VERS = "vs0 as (select id, stage, built_at, nodes, unnest(range(len(nodes))) i from subgraph), vs as (select id, stage, built_at, i, nodes[i+1].qid qid, nodes[i+1].label lab, nodes[i+1].description dsc, nodes[i+1].instance_of io, nodes[i+1].subclass_of so, nodes[i+1].props pr, nodes[i+1].extra_props xp from vs0 where nodes[i+1].qid is not null)"
_BR = f"""{REC}, {SD}, {C}, {G}, {N}, {LP.replace('lp as', 'lp9 as')}, lp as (select * from lp9 where a is not null and id in (select id from g)), {L1}, {L2},
br as (select id, '1hop' kind, 1 len, case when direction = 0 then a || '|' || "type" || '|' || b else b || '|' || "type" || '|' || a end path, null x from l1
 union all select id, '2hop', 2, case when direction = 0 then a || '|' || p1 || '|' || x || ' ' || x || '|' || p2 || '|' || b else b || '|' || p1 || '|' || x || ' ' || x || '|' || p2 || '|' || a end, x from l2 where rank = 1 and id not in (select id from l1))"""
_JU = f"""{REC}, {G}, {N}, {TR}, {AT},
c3 as (select id, qid, row_number() over (partition by id order by score desc, node_ord)::int rank from tr where id in (select id from tr group by id having min(tier) = 3)),
nl as (select id, qid, arg_min(coalesce("label", ''), node_ord) lab from n where qid is not null group by id, qid),
ca as (select c3.id, c3.rank, c3.qid, answer, case when coalesce(lab, '') <> '' then lab else c3.qid end lab from c3 join nl using (id, qid) join rec using (id)),
ok as (select id, arg_min(qid, rank) qid, min(rank) rank from ca where contains(answer, lab) or contains(lab, answer) group by id),
rt as (select ans.id, case when g.id is null or ans.tier = 4 or (ans.tier = 3 and ok.qid is null) then 'not_found' else 'found' end route,
 case when g.id is null then 'no_subgraph' when ans.tier = 4 then 'no_match' when ans.tier = 3 and ok.qid is null then 'tier3_declined' end reason,
 case when g.id is null then null when ans.tier <= 2 then ans.qid when ans.tier = 3 then ok.qid end qid, case when g.id is null then null else ans.tier::int end tier
 from ans left join g using (id) left join ok using (id))"""
_esc = lambda s: s.replace("'", "''")
_ctx = g.ORACLES["context_text"].removeprefix("with ")
_ctx_sql = _ctx[: _ctx.rindex("select id, string_agg('Entity")] + ", cx as (" + _ctx[_ctx.rindex("select id, string_agg('Entity") :] + ")"

ORACLES = {
    "build_subgraphs": f"with {_B} select id, section, source, \"type\", target from be",
    "build_nodes": f"with {_B}, {_INFO}, bn as (select id, qid from en union select id, target from be where section <> 'TYPE') select bn.id, bn.qid, coalesce(\"label\", bn.qid) \"label\", coalesce(description, '') description from bn left join inf on inf.qid = bn.qid",
    "build_missing": f"with {_B} select id, section, source, \"type\", target from be where id not in (select id from subgraph where id is not null)",
    "patched_edges": f"""with recursive {G}, {N}, {E}, {C}, {_CLOSE}
select distinct a.id, c.qid source, c.pid "type", c.target from rc a join c on c.qid = a.qid join rc b on b.id = a.id and b.qid = c.target union select id, source, "type", target from e where "type" = 'TYPE'""",
    "patch_tally": f"""with recursive {G}, {N}, {C}, {_CLOSE}, ad as (select id, count(*) k from (select id, qid from rc except select id, qid from mb) group by id)
select case when coalesce(k, 0) > 0 then 'patched' else 'already_ok' end status, count(*) graphs, coalesce(sum(k), 0)::bigint added from g left join ad using (id) group by 1""",
    "node_merge": f"""with {_VERS}, a as (select qid, arg_min(lab, (id, stage, built_at, i)) filter (lab <> '') "label", arg_min(dsc, (id, stage, built_at, i)) filter (dsc <> '') description from vs group by qid),
b as (select qid, string_agg(k, '|' order by k) io from (select distinct qid, unnest(io) k from vs) where k is not null group by qid), c as (select qid, string_agg(k, '|' order by k) so from (select distinct qid, unnest(so) k from vs) where k is not null group by qid)
select a.qid, "label", description, coalesce(io, '') instance_of, coalesce(so, '') subclass_of from a left join b using (qid) left join c using (qid)""",
    "node_merge_props": f"""with {_VERS}, m as (select qid, 'props' field, unnest(map_entries(pr)) m from vs union all select qid, 'extra_props', unnest(map_entries(xp)) from vs)
select distinct qid, field, m.key pid, trim(v) target from (select qid, field, m, unnest(m.value) v from m) where trim(v) <> ''""",
    "entity_fetch": f"with {REC}, {SD}, {_INFO} select s.qid, \"label\", description, inf.qid is null missing from (select distinct q qid from sd) s left join inf on inf.qid = s.qid",
    "fetch_batches": f"with {REC}, {SD} select qid, (row_number() over (order by md5(qid), qid) - 1) // 50 batch from (select distinct q qid from sd)",
    "claim_targets": """with m as (select qid, unnest(map_entries(props)) m from graph_node), v as (select qid, m.key pid, m.value vs, unnest(range(len(m.value))) i from m)
select distinct qid, pid, i::int ord, trim(vs[i+1]) target from v where regexp_full_match(trim(vs[i+1]), 'Q[0-9]+')""",
    "paths_exist": f"with recursive {REC}, {G}, {E}, {SD}, {CO}, {Q} select q.id, sd.q source, q.answer goal, coalesce(a.component = b.component, false) found from q join sd using (id) left join co a on a.id = q.id and a.qid = sd.q left join co b on b.id = q.id and b.qid = q.answer",
    "bridge_patch": f"with {_BR} select id, kind, len::int length, path from br",
    "bridge_nodes": f"with {_BR}, {_INFO} select b.id, b.x qid, coalesce(\"label\", b.x) \"label\", coalesce(description, '') description from (select distinct id, x from br where kind = '2hop') b left join inf on inf.qid = b.x where not exists (select 1 from n where n.id = b.id and n.qid = b.x)",
    "bridge_tally": f"""with {_BR} select case when coalesce(len(supporting_paths), 0) > 0 then 'already_has_path' when kind is not null then 'patched_' || kind when lp.id is not null then 'not_found' else 'skipped' end outcome, count(*) n
from rec left join br using (id) left join lp on lp.id = rec.id where difficulty = 'entity_selection' group by 1""",
    "answer_verdicts": f"with {_JU} select id, route, reason, qid, tier from rt",
    "answer_retry": f"""with {_JU}, ok2 as (select id, arg_min(qid, rank) qid from ca where list_bool_or(list_transform(string_split(answer, ' '), lambda w: length(w) > 3 and contains(lab, w))) group by id)
select rt.id, ok2.qid, case when ok2.qid is not null then 'found' else 'not_found' end route from rt left join ok2 using (id) where reason = 'tier3_declined'""",
    "merged_records": f"""{g._PATHS}, {g.SG}, {g.F4}, {g.AN} select rec.id, question, rec.answer, trim(answer_node_qid) answer_node_qid, coalesce(rec.answer, '') aliases, reasoning_type, ann.difficulty, ann.strategy strategy_used, n_paths > 0 path_found, match_tier, coalesce(len(entities), 0)::int n_entities, coalesce(len(matched_ontologies), 0)::int n_ontologies, case when reasoning_type = 'comparison' then '' else paths end paths
from rec join ann on ann.id = rec.id where ann.difficulty <> 'no_path'""",
    "merge_counts": "select count(*) annotated, count(*) filter (not known) unmatched from (select distinct id, id in (select id from split_record where id is not null) known from prediction where id is not null)",
    "redirect_links": f"""with {REC}, t as (select distinct title from (select unnest(entities).title title from rec) where title is not null), f as (select label title, min(qid) f from graph_node where label is not null and qid is not null group by 1),
s as (select title, min(trim(qid)) s from documents where title is not null and trim(qid) <> '' group by 1), k as (select qid, string_agg(k, '|' order by k) cls from (select distinct qid, unnest(instance_of) k from graph_node) group by qid), l as (select qid, min(label) can from graph_node group by qid)
select t.title, coalesce(f, s) qid, case when f is null and trim(can) <> '' then trim(can) else t.title end canonical, coalesce(cls, '') classes from t left join f using (title) left join s using (title) left join k on k.qid = coalesce(f, s) left join l on l.qid = coalesce(f, s)""",
    "label_precedence": """with r as (select id, relations r, unnest(range(len(relations))) i from ontology), c as (select id, concepts c, unnest(range(len(concepts))) i from ontology),
a as (select 'pid' kind, r[i+1].pid k, trim(r[i+1].label) lab, 1 x, id place, i from r union all select 'class', c[i+1].qid, trim(c[i+1].label), 1, id, i from c union all select 'class', qid, trim(min(label) filter (trim(label) <> '')), 0, '', 0 from graph_node group by qid)
select kind, k id, arg_max(lab, (x, place, i)) "label" from a where k is not null and lab <> '' and lab <> k group by kind, k""",
    "ontology_counts": "select qid, count(distinct id) n from (select id, unnest(concepts).qid qid from ontology) where qid is not null group by qid",
    "comparison_found": f"with {REC}, {G}, {N}, {E}, {g.NE}, {g.ADJ}, {SD} select sd.id, bool_or(exists (select 1 from adj where adj.id = sd.id and adj.source = sd.q)) found from sd join rec on rec.id = sd.id and reasoning_type = 'comparison' group by sd.id",
    "prompts_few_shot": f"with {REC} select id, '{_esc(_opening(_SHOTS))}' || coalesce(question, '') prompt from rec",
    "prompts_oracle": f"with {_ctx_sql} select rec.id, case when coalesce(cx.context, '') <> '' then '{_esc(_opening(_FACT_SHOTS))}Facts:' || chr(10) || cx.context || chr(10) || chr(10) || 'Question: ' || coalesce(question, '') else '{_esc(_opening(_SHOTS))}' || coalesce(question, '') end prompt from rec left join cx using (id)",
    "context_report": f"""with {SCORED}, c as (select *, case when difficulty = 'traversal' then 'oracle_full' when difficulty = 'entity_selection' and len(supporting_paths) > 0 then 'oracle_full' else 'oracle_partial' end context_type from s)
select case when grouping(context_type) = 0 then 'context_type' when grouping(difficulty) = 0 then 'difficulty' when grouping(reasoning_type) = 0 then 'reasoning_type' else 'global' end dimension,
case when grouping(context_type) = 0 then context_type when grouping(difficulty) = 0 then coalesce(difficulty, 'none') when grouping(reasoning_type) = 0 then coalesce(reasoning_type, 'none') else 'all' end "key",
100 * avg(em) em, 100 * avg(f1) f1, count(*) n from c group by grouping sets ((), (context_type), (difficulty), (reasoning_type))""",
    "coverage_top": f"""with {REC}, c as (select id, len(list_distinct(list_transform(entities, lambda e: e.title)))::int titles, len(list_distinct(list_transform(entities, lambda e: e.qid)))::int linked from rec where reasoning_type = 'bridge')
select id, titles, linked, titles - linked missing from c where titles > linked order by missing desc, id limit 20""",
    "coverage_join": f"""with {REC}, w as (select id, context from (select *, row_number() over (partition by id order by ingested_at desc, source desc nulls last) rn from split_record where id is not null) where rn = 1),
x as (select rec.id, coalesce(len(list_distinct(list_transform(entities, lambda e: e.qid))), 0)::int linked, len(list_distinct(list_transform(w.context, lambda e: e.title)))::int raw_titles from rec left join w using (id) where reasoning_type = 'bridge') select * from x where raw_titles > linked""",
    "demo_sample": f"with {REC} select id, strategy_used, difficulty from rec where match_tier = 1 order by case when strategy_used = 1 then 0 else 1 end, md5('42|' || id), id limit 25",
    "subset_records": f"with {REC} select id, split, source from rec where id in (select id from prediction where model = 'kgqa_large')",
    "stamped_documents": "select doc_id, strftime(fetched_at, '%Y-%m-%dT%H:%M:%S.%f') iso, fetched_at::date \"day\", hour(fetched_at)::int \"hour\" from documents",
    "triple_texts": f"""with {REC}, p as (select id, supporting_paths sp, unnest(range(len(supporting_paths))) i from rec), x as (select id, i, sp[i+1].triples ts, unnest(range(len(sp[i+1].triples))) j from p)
select id, i::int path_ord, j::int ord, '(' || ts[j+1][1] || ') --[' || ts[j+1][2] || ']--> (' || ts[j+1][3] || ')' "text" from x""",
}
ORACLES["eval_report"] = f"""with rep as ({kgqa.ORACLES['eval_grouping']}) select row_number() over (order by dimension, "key")::int line_no,
dimension || ' ' || "key" || ': n=' || n || ' EM ' || printf('%.1f', round(em * 100, 1)) || '% F1 ' || printf('%.1f', round(f1 * 100, 1)) || '%' || case when h1 is null then '' else ' H@1 ' || printf('%.1f', round(h1 * 100, 1)) || '%' end line from rep"""
