"""Queries over records, replies and documents, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import metrics, rows

#: Records by their first delivery.
REC = "rec as (select * exclude (rn) from (select *, row_number() over (partition by id order by ingested_at, source) rn from split_record where id is not null) where rn = 1)"
#: The last reply of each model to each question.
REPLY = "reply as (select * exclude (rn) from (select *, row_number() over (partition by id, model order by produced_at desc, pred_id desc) rn from prediction) where rn = 1)"
WORDS = "list_filter(regexp_split_to_array(lower(coalesce({}, '')), '[^\\p{{L}}\\p{{N}}_]+'), lambda w: w <> '')"
SCORE = "list_filter(regexp_split_to_array(lower(coalesce({}, '')), '[^\\p{{L}}\\p{{N}}_]+'), lambda w: w not in ('', 'a', 'an', 'the'))"
STRIP = "regexp_replace({}, '^[\\s\\x{{a0}}]+|[\\s\\x{{a0}}]+$', '', 'g')"


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def records(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """Distinct records with the given columns, each by its first delivery."""
    return rows.first_rows(t(spark, d, "split_record"), "id", ["ingested_at", "source"], list(cols))


def replies(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return rows.last_rows(t(spark, d, "prediction"), ["id", "model"], ["produced_at", "pred_id"], ["pred_id", *cols])


def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d, "question", "source", "ingested_at")


def dedup_last(spark: SparkSession, d: str) -> DataFrame:
    return replies(spark, d, "pred_answer", "produced_at")


def normalize_match(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select("doc_id", T.match_form(F.col("title")).alias("form"))


def normalize_score(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "prediction").select("pred_id", T.score_form(F.col("pred_answer")).alias("form"))


def token_jaccard(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "prediction").join(records(spark, d, "answer"), "id")
    return p.select("pred_id", T.jaccard(F.array_distinct(T.words(F.col("pred_answer"))), F.array_distinct(T.words(F.col("answer")))).alias("jaccard"))


def tier_score(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "prediction").join(records(spark, d, "answer"), "id")
    return p.select("pred_id", T.fuzzy_score(T.match_form(F.col("pred_answer")), T.match_form(F.col("answer"))).alias("score"))


def _scored(spark: SparkSession, d: str, dimensions: list[str], extra: list[str] | None = None) -> DataFrame:
    rec = records(spark, d, "answer", "answer_aliases", "answer_node_qid", "difficulty", "reasoning_type", *(extra or []))
    if "context_type" in dimensions:
        rec = rec.withColumn("context_type", metrics.context_type())
    return metrics.scored_replies(replies(spark, d, "pred_answer", "pred_qid"), rec, dimensions)


def em_f1(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d, []).select("pred_id", "em", "f1")


def hits_at_1(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d, []).select("pred_id", "h1")


def eval_grouping(spark: SparkSession, d: str) -> DataFrame:
    has = t(spark, d, "prediction").agg(F.coalesce(F.bool_or(F.coalesce(F.col("pred_qid"), F.lit("")) != ""), F.lit(False)).alias("has_qid"))
    return metrics.metric_report(_scored(spark, d, ["difficulty", "reasoning_type", "model"]), ["difficulty", "reasoning_type", "model"], has)


def eval_multilabel(spark: SparkSession, d: str) -> DataFrame:
    s = _scored(spark, d, ["matched_ontologies"], ["matched_ontologies"])
    return s.select("em", "f1", "h1", F.explode("matched_ontologies.ont_id").alias("key")).groupBy("key").agg(F.avg("em").alias("em"), F.avg("f1").alias("f1"), F.avg("h1").alias("h1"), F.count("*").alias("n"))


def eval_context(spark: SparkSession, d: str) -> DataFrame:
    s = _scored(spark, d, ["model", "context_type"], ["supporting_paths"])
    return s.groupBy("model", "context_type").agg(F.avg("em").alias("em"), F.avg("f1").alias("f1"), F.count("*").alias("n"))


def missing_replies(spark: SparkSession, d: str) -> DataFrame:
    """Per split: records, and records that no model replied to."""
    done = t(spark, d, "prediction").select("id").distinct().withColumn("has", F.lit(1))
    return records(spark, d, "split").join(done, "id", "left").groupBy("split").agg(F.count("*").alias("records"), F.count_if(F.col("has").isNull()).alias("missing"))


def strat_split(spark: SparkSession, d: str) -> DataFrame:
    rec = records(spark, d, "difficulty", "reasoning_type")
    return rows.stratified_split(rec, "id", F.concat_ws("__", F.coalesce("difficulty", F.lit("none")), "reasoning_type"))


def split_counts(spark: SparkSession, d: str) -> DataFrame:
    return strat_split(spark, d).groupBy("stratum").agg(*(F.count_if(F.col("split") == s).alias(s) for s in ("train", "dev", "test")))


def overlay_merge(spark: SparkSession, d: str) -> DataFrame:
    g = t(spark, d, "subgraph").select("id", "stage", F.size("nodes").alias("n_nodes"))
    return rows.overlay(g.where("stage = 'extended'"), g.where("stage = 'patched'"), "id", "n_nodes")


def resume_anti(spark: SparkSession, d: str) -> DataFrame:
    """Records that no usable reply of the largest model exists for."""
    done = t(spark, d, "prediction").where("model = 'kgqa_large' and trim(pred_answer) <> ''")
    return rows.undone(records(spark, d, "split"), done, "id")


def publish_fields(spark: SparkSession, d: str) -> DataFrame:
    """Published records: internal fields dropped, ontologies matched by the universal class only removed, records without a path left out."""
    rec = records(spark, d, "question", "answer", "answer_node_qid", "reasoning_type", "match_tier", "strategy_used", "difficulty", "matched_ontologies")
    kept = F.filter("matched_ontologies", lambda m: m["matched_qids"] != F.array(F.lit("Q5")))
    return rec.where("difficulty is null or difficulty <> 'no_path'").withColumn("ontologies", F.array_join(F.transform(kept, lambda m: m["ont_id"]), "|")).drop("matched_ontologies")


def ontology_route(spark: SparkSession, d: str) -> DataFrame:
    """Where each record goes by its matched ontologies: kept, q5_only or dropped."""
    rec = records(spark, d, "matched_ontologies")
    qids = F.array_distinct(F.flatten(F.coalesce(F.col("matched_ontologies.matched_qids"), F.array().cast("array<array<string>>"))))
    route = F.when(F.coalesce(F.size("matched_ontologies"), F.lit(0)) <= 0, "dropped").when(qids == F.array(F.lit("Q5")), "q5_only").otherwise("kept")
    return rec.select("id", route.alias("route"))


def dataset_stats(spark: SparkSession, d: str) -> DataFrame:
    """Per split and in total: records, connected and disconnected entity selections, and the share of records with a path."""
    rec = records(spark, d, "split", "difficulty", "path_found", "supporting_paths")
    has = F.coalesce(F.size("supporting_paths") > 0, F.lit(False))
    s0 = F.col("difficulty") == "entity_selection"
    out = rec.rollup("split").agg(F.count("*").alias("records"), F.count_if(s0 & has).alias("connected"), F.count_if(s0 & ~has).alias("disconnected"), F.count_if("path_found").alias("found"))
    return out.select(F.coalesce("split", F.lit("total")).alias("split"), "records", "connected", "disconnected", metrics.share(F.col("found"), F.col("records")).alias("found_share"))


def coverage_report(spark: SparkSession, d: str) -> DataFrame:
    """Records whose entity titles are more than the distinct entity ids: titles without an id, and missing counts."""
    rec = records(spark, d, "entities", "reasoning_type").where("reasoning_type = 'bridge'")
    titles = F.size(F.array_distinct(F.coalesce(F.col("entities.title"), F.array().cast("array<string>"))))
    linked = F.size(F.array_distinct(F.filter(F.coalesce(F.col("entities.qid"), F.array().cast("array<string>")), lambda q: q.isNotNull())))
    return rec.select("id", titles.alias("titles"), linked.alias("linked")).where("titles > linked").withColumn("missing", F.col("titles") - F.col("linked"))


def flatten_entities(spark: SparkSession, d: str) -> DataFrame:
    """Entity rows grouped by title in the order of first appearance, repeats kept."""
    e = records(spark, d, "entities").select("id", F.posexplode("entities").alias("pos", "e"))
    firsts = e.groupBy("id", F.col("e.title").alias("title")).agg(F.min("pos").alias("first_pos"))
    return e.select("id", "pos", F.col("e.title").alias("title"), F.col("e.sentence_idx").alias("sentence_idx"), F.col("e.qid").alias("qid")).join(firsts, ["id", "title"])


def entity_lists(spark: SparkSession, d: str) -> DataFrame:
    """The entity ids of each record: trimmed, distinct, in order of appearance, joined by a bar."""
    ids = F.filter(F.transform("entity_qids", T.strip), lambda q: q != "")
    return records(spark, d, "entity_qids").select("id", F.array_join(F.array_distinct(ids), "|").alias("qids"))


def parse_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "prediction").select("pred_id", T.verdict(F.col("pred_answer")).alias("verdict"), T.uri_tail(F.concat(F.lit("http://x/"), F.col("pred_qid"))).alias("tail"))


def prompts(spark: SparkSession, d: str) -> DataFrame:
    """Closed-book prompts: system and user messages in one text."""
    return records(spark, d, "question").select("id", F.concat(F.lit("[system] Answer with a short phrase.\n[user] "), F.coalesce("question", F.lit(""))).alias("prompt"))


QUERIES = {
    f.__name__: f
    for f in (dedup_first, dedup_last, normalize_match, normalize_score, token_jaccard, tier_score, em_f1, hits_at_1, eval_grouping, eval_multilabel, eval_context, missing_replies, strat_split, split_counts, overlay_merge, resume_anti, publish_fields, ontology_route, dataset_stats, coverage_report, flatten_entities, entity_lists, parse_verdicts, prompts)
}

_P, _G = SCORE.format("pred_answer"), SCORE.format("a")
SCORED = f"""{REC}, {REPLY},
gold as (select id, answer_node_qid gold_qid, difficulty, reasoning_type, matched_ontologies, supporting_paths, case when len(answer_aliases) > 0 then answer_aliases else [answer] end aliases from rec),
s0 as (select r.pred_id, r.model, r.pred_qid, g.*, {_P} p, list_transform(aliases, lambda a: {_G}) gs from reply r join gold g using (id)),
s as (select *,
  case when list_bool_or(list_transform(gs, lambda g: array_to_string(g, ' ') = array_to_string(p, ' '))) then 1.0::double else 0.0::double end em,
  coalesce(list_max(list_transform(gs, lambda g: case when len(list_intersect(p, g)) > 0 then 2.0::double * (len(list_intersect(p, g))::double / len(p)) * (len(list_intersect(p, g))::double / len(g)) / (len(list_intersect(p, g))::double / len(p) + len(list_intersect(p, g))::double / len(g)) else 0.0::double end)), 0.0::double) f1,
  case when trim(pred_qid) = trim(gold_qid) then 1.0::double else 0.0::double end h1
  from s0)"""
_JACC = "case when len(x) > 0 and len(y) > 0 then len(list_intersect(x, y))::double / len(list_distinct(list_concat(x, y))) else 0.0::double end"
_SPLIT = f"""{REC},
b as (select id, coalesce(difficulty, 'none') || '__' || reasoning_type stratum from rec),
k as (select *, row_number() over (partition by stratum order by md5('42|' || id), id) r, count(*) over (partition by stratum) n from b),
q as (select *, greatest(1, round_even(n * 0.7, 0))::bigint t, greatest(1, round_even(n * 0.15, 0))::bigint d from k),
sp as (select id, stratum, case when t + d > n then 'train' when r <= t then 'train' when r <= t + d then 'dev' else 'test' end split from q)"""

ORACLES = {
    "dedup_first": f"with {REC} select id, question, source, ingested_at from rec",
    "dedup_last": f"with {REPLY} select id, model, pred_id, pred_answer, produced_at from reply",
    "normalize_match": f"select doc_id, array_to_string({WORDS.format('title')}, ' ') form from documents",
    "normalize_score": f"select pred_id, array_to_string({SCORE.format('pred_answer')}, ' ') form from prediction",
    "token_jaccard": f"with {REC}, w as (select pred_id, list_distinct({WORDS.format('pred_answer')}) x, list_distinct({WORDS.format('answer')}) y from prediction join rec using (id)) select pred_id, {_JACC} jaccard from w",
    "tier_score": f"""with {REC}, w as (select pred_id, array_to_string({WORDS.format('pred_answer')}, ' ') a, array_to_string({WORDS.format('answer')}, ' ') b from prediction join rec using (id)),
v as (select *, list_distinct(list_filter(string_split(a, ' '), lambda w: w <> '')) x, list_distinct(list_filter(string_split(b, ' '), lambda w: w <> '')) y from w)
select pred_id, case when least(length(a), length(b)) >= 3 and (contains(a, b) or contains(b, a)) then 0.5::double + least(length(a), length(b))::double / (greatest(length(a), length(b)) + 1) when {_JACC} >= 0.5 then {_JACC} else 0.0::double end score from v""",
    "em_f1": f"with {SCORED} select pred_id, em, f1 from s",
    "hits_at_1": f"with {SCORED} select pred_id, h1 from s",
    "eval_grouping": f"""with {SCORED}, h as (select bool_or(coalesce(pred_qid, '') <> '') has from prediction)
select case when grouping(difficulty) = 0 then 'difficulty' when grouping(reasoning_type) = 0 then 'reasoning_type' when grouping(model) = 0 then 'model' else 'global' end dimension,
case when grouping(difficulty) = 0 then coalesce(difficulty, 'none') when grouping(reasoning_type) = 0 then coalesce(reasoning_type, 'none') when grouping(model) = 0 then coalesce(model, 'none') else 'all' end "key",
avg(em) em, avg(f1) f1, case when any_value(has) then avg(h1) end h1, count(*) n from s, h group by grouping sets ((), (difficulty), (reasoning_type), (model))""",
    "eval_multilabel": f"with {SCORED}, e as (select em, f1, h1, unnest(matched_ontologies).ont_id k from s) select k \"key\", avg(em) em, avg(f1) f1, avg(h1) h1, count(*) n from e group by k",
    "eval_context": f"with {SCORED}, c as (select *, case when difficulty = 'traversal' then 'oracle_full' when difficulty = 'entity_selection' and len(supporting_paths) > 0 then 'oracle_full' else 'oracle_partial' end context_type from s) select model, context_type, avg(em) em, avg(f1) f1, count(*) n from c group by model, context_type",
    "missing_replies": f"with {REC} select split, count(*) records, count(*) filter (id not in (select id from prediction where id is not null)) missing from rec group by split",
    "strat_split": f"with {_SPLIT} select id, stratum, split from sp",
    "split_counts": f"with {_SPLIT} select stratum, count(*) filter (split = 'train') train, count(*) filter (split = 'dev') dev, count(*) filter (split = 'test') test from sp group by stratum",
    "overlay_merge": """with g as (select id, stage, len(nodes)::int n_nodes from subgraph), b as (select * from g where stage = 'extended'), p as (select * from g where stage = 'patched')
select coalesce(b.id, p.id) id, case when p.id is not null then p.n_nodes else b.n_nodes end n_nodes, case when p.id is null then 'kept' when b.id is null then 'added' else 'overridden' end origin from b full join p on b.id = p.id""",
    "resume_anti": f"with {REC} select id, split from rec where not exists (select 1 from prediction p where p.id = rec.id and model = 'kgqa_large' and trim(pred_answer) <> '')",
    "publish_fields": f"""with {REC} select id, question, answer, answer_node_qid, reasoning_type, match_tier, strategy_used, difficulty,
array_to_string(list_transform(list_filter(matched_ontologies, lambda m: m.matched_qids <> ['Q5']), lambda m: m.ont_id), '|') ontologies from rec where difficulty is null or difficulty <> 'no_path'""",
    "ontology_route": f"with {REC} select id, case when coalesce(len(matched_ontologies), 0) = 0 then 'dropped' when list_distinct(flatten(list_transform(matched_ontologies, lambda m: m.matched_qids))) = ['Q5'] then 'q5_only' else 'kept' end route from rec",
    "dataset_stats": f"""with {REC} select coalesce(split, 'total') split, count(*) records, count(*) filter (difficulty = 'entity_selection' and len(supporting_paths) > 0) connected,
count(*) filter (difficulty = 'entity_selection' and coalesce(len(supporting_paths), 0) = 0) disconnected, 100.0::double * count(*) filter (path_found) / count(*) found_share from rec group by rollup (split)""",
    "coverage_report": f"""with {REC}, c as (select id, len(list_distinct(list_transform(entities, lambda e: e.title)))::int titles, len(list_distinct(list_transform(entities, lambda e: e.qid)))::int linked from rec where reasoning_type = 'bridge')
select id, titles, linked, titles - linked missing from c where titles > linked""",
    "flatten_entities": f"""with {REC}, e as (select id, entities es, unnest(range(len(entities))) i from rec), x as (select id, i::int pos, es[i+1].title title, es[i+1].sentence_idx sentence_idx, es[i+1].qid qid from e)
select id, title, pos, sentence_idx, qid, min(pos) over (partition by id, title) first_pos from x""",
    "entity_lists": f"""with {REC}, e as (select id, unnest(range(len(entity_qids))) i, entity_qids q from rec), x as (select id, trim(q[i+1]) q, min(i) i from e where trim(q[i+1]) <> '' group by 1, 2),
l as (select id, string_agg(q, '|' order by i) qids from x group by id) select rec.id, case when entity_qids is null then null else coalesce(qids, '') end qids from rec left join l using (id)""",
    "parse_verdicts": r"""select pred_id, case when contains(s, 'yes') then true when contains(s, 'no') then false end verdict, 'http://x/' || pred_qid as u, case when pred_qid is null then null else string_split('http://x/' || pred_qid, '/')[-1] end tail from (select *, lower(regexp_replace(pred_answer, '(?s)<think>.*?</think>', '', 'g')) s from prediction)""".replace("'http://x/' || pred_qid as u, ", ""),
    "prompts": f"with {REC} select id, '[system] Answer with a short phrase.' || chr(10) || '[user] ' || coalesce(question, '') prompt from rec",
}
