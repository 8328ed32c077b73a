"""Queries that write tables with each sink and read them with each source again, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dewey
from ..session import Scratch
from ..sources import readers, sinks
from .kgqa import REC, coverage_report, ontology_route, records, t


def _place(spark: SparkSession, name: str) -> str:
    return f"{Scratch(spark, name).root}/out"


def io_json_lines(spark: SparkSession, d: str) -> DataFrame:
    """Replies as JSON lines: written once, forced to be written again, and read strictly."""
    at = _place(spark, "lines")
    df = t(spark, d, "prediction").select("pred_id", "id", "pred_answer", "model")
    sinks.json_lines(df, at)
    sinks.json_lines(df, at, force=True)
    return readers.json_lines(spark, at, "pred_id bigint, id string, pred_answer string, model string", "FAILFAST")


def io_malformed(spark: SparkSession, d: str) -> DataFrame:
    """Stored bodies as lines of text, of which only valid ones come back."""
    at = _place(spark, "malformed")
    t(spark, d, "raw_subgraph").where("body is not null").select(F.regexp_replace("body", "[\r\n]+", " ")).write.text(at)
    read = readers.json_lines(spark, at, "id string, nodes string", "DROPMALFORMED").where("id is not null")
    return read.groupBy("id").agg(F.count("*").alias("n"))


def io_array(spark: SparkSession, d: str) -> DataFrame:
    """Questions of two splits as files that hold one array each."""
    at = _place(spark, "array")
    rec = records(spark, d, "question", "answer", "reasoning_type", "split").where("split in ('train', 'dev')")
    raw = rec.select("split", F.struct(F.col("id").alias("_id"), "question", "answer", F.col("reasoning_type").alias("type")).alias("r"))
    # A file is an array of what one hash part of a split holds.
    parts = raw.withColumn("part", F.pmod(F.xxhash64("r._id"), F.lit(64))).groupBy("split", "part").agg(F.to_json(F.collect_list("r")).alias("value"))
    parts.select("value", "split", "part").write.partitionBy("split", "part").text(at)
    read = readers.json_array(spark, f"{at}/*/*/", "_id string, question string, answer string, type string")
    return readers.linked_questions(read.withColumn("supporting_facts", F.lit(None).cast("array<array<string>>"))).select("id", "question", "answer", "reasoning_type")


def io_keyed(spark: SparkSession, d: str) -> DataFrame:
    """Graphs kept by key: patched ones, and those of the first stage where no patched one exists."""
    at = _place(spark, "keyed")
    g = t(spark, d, "subgraph").where("id is not null").select("id", "stage", F.size("edges").alias("n_edges")).groupBy("id", "stage").agg(F.max("n_edges").alias("n_edges"))
    sinks.keyed_documents(g.where("stage = 'patched'"), "id", f"{at}/patched")
    sinks.keyed_documents(g.where("stage = 'extended'"), "id", f"{at}/extended")
    return readers.keyed_documents(spark, f"{at}/patched", "id string, stage string, n_edges int", f"{at}/extended", lines=True)


def io_routed(spark: SparkSession, d: str) -> DataFrame:
    """Records written by route in one pass, counted from their folders."""
    at = _place(spark, "routed")
    sinks.routed(ontology_route(spark, d), "route", at)
    return spark.read.schema("id string, route string").json(at).groupBy("route").agg(F.count("*").alias("n"))


def io_tsv(spark: SparkSession, d: str) -> DataFrame:
    """A report as tab-separated text."""
    at = _place(spark, "tsv")
    sinks.tsv(coverage_report(spark, d), at)
    return spark.read.schema("id string, titles int, linked int, missing int").option("sep", "\t").option("header", True).csv(at)


def io_append(spark: SparkSession, d: str) -> DataFrame:
    """Labels fetched in two runs: the second appends only what the first lacks."""
    at = _place(spark, "append")
    n = t(spark, d, "graph_node").where("qid is not null").groupBy("qid").agg(F.min("label").alias("label"))
    sinks.append_undone(n.where("qid < 'Q5'"), "qid", at)
    sinks.append_undone(n, "qid", at)
    return spark.read.schema("qid string, label string").json(at)


def io_replace(spark: SparkSession, d: str) -> DataFrame:
    """A table overwritten by rows that are read from it."""
    at = _place(spark, "replace")
    schema = "id string, difficulty string"
    records(spark, d, "difficulty").write.parquet(at)
    sinks.replace_in_place(spark.read.schema(schema).parquet(at).where("difficulty is null or difficulty <> 'no_path'"), at)
    return spark.read.schema(schema).parquet(at)


def io_ontologies(spark: SparkSession, d: str) -> DataFrame:
    """Ontology files, one without its id, in the order of their names, with the relations that they list."""
    at = _place(spark, "ontologies")
    o = t(spark, d, "ontology").withColumn("file", F.col("id"))
    written = o.select("file", F.to_json(F.struct("title", F.when(F.col("id") != "ont_1_", F.col("id")).alias("id"), "concepts", "relations", "concepts_to_extend")).alias("value"))
    readers.named_files(spark, written, "file", "value", at)
    read = readers.ontologies(spark, at)
    return read.select("id", "ont_pos", F.posexplode("relations").alias("rel_pos", "r")).select("id", "ont_pos", "rel_pos", "r.pid", "r.domain", F.array_join("r.range", "|").alias("range"))


def io_best_label(spark: SparkSession, d: str) -> DataFrame:
    """The label to show of titles in several languages: English, else common to all, else any with its language."""
    docs = t(spark, d, "documents").where("title is not null and trim(qid) <> ''").select(F.trim("qid").alias("qid"), F.coalesce(F.lower(F.trim("lang")), F.lit("mul")).alias("lang"), "title")
    names = docs.groupBy("qid", "lang").agg(F.min("title").alias("title")).groupBy("qid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", "title")))).alias("labels"))
    return names.select("qid", readers.best_label(F.col("labels")).alias("label"))


def io_parsed(spark: SparkSession, d: str) -> DataFrame:
    """Graphs that exist as JSON text, with the number of their nodes."""
    return dewey.parse_subgraphs(t(spark, d, "raw_subgraph"), keep=["line_no"]).select("line_no", "id", F.when(F.col("nodes").isNotNull(), F.size("nodes")).alias("n_nodes"))


QUERIES = {f.__name__: f for f in (io_json_lines, io_malformed, io_array, io_keyed, io_routed, io_tsv, io_append, io_replace, io_ontologies, io_best_label, io_parsed)}

ORACLES = {
    "io_json_lines": "select pred_id, id, pred_answer, model from prediction",
    "io_malformed": "select json_extract_string(body, '$.id') id, count(*) n from raw_subgraph where json_valid(body) and json_extract_string(body, '$.id') is not null group by 1",
    "io_array": f"with {REC} select id, question, answer, reasoning_type from rec where split in ('train', 'dev')",
    "io_keyed": "with g as (select id, stage, max(len(edges))::int n_edges from subgraph where id is not null group by id, stage) select * from g where stage = 'patched' union all select * from g where stage = 'extended' and id not in (select id from g where stage = 'patched')",
    "io_routed": f"with {REC} select case when coalesce(len(matched_ontologies), 0) = 0 then 'dropped' when list_distinct(flatten(list_transform(matched_ontologies, lambda m: m.matched_qids))) = ['Q5'] then 'q5_only' else 'kept' end route, count(*) n from rec group by 1",
    "io_tsv": f"""with {REC}, c as (select id, len(list_distinct(list_transform(entities, lambda e: e.title)))::int titles, len(list_distinct(list_transform(entities, lambda e: e.qid)))::int linked from rec where reasoning_type = 'bridge')
select id, titles, linked, titles - linked missing from c where titles > linked""",
    "io_append": "select qid, min(label) \"label\" from graph_node where qid is not null group by qid",
    "io_replace": f"with {REC} select id, difficulty from rec where difficulty is null or difficulty <> 'no_path'",
    "io_ontologies": """with o as (select id, row_number() over (order by id) - 1 ont_pos, relations r, unnest(range(len(relations))) i from ontology), p as (select id, row_number() over (order by id)::int - 1 ont_pos from ontology)
select o.id, p.ont_pos, i::int rel_pos, r[i+1].pid pid, r[i+1].domain "domain", coalesce(array_to_string(r[i+1].range, '|'), '') "range" from o join p using (id)""",
    "io_best_label": """with d as (select trim(qid) qid, coalesce(lower(trim(lang)), 'mul') lang, min(title) title from documents where title is not null and trim(qid) <> '' group by 1, 2)
select qid, coalesce(max(title) filter (lang = 'en'), max(title) filter (lang = 'mul'), arg_min(title, lang) || ' [' || min(lang) || ']') "label" from d group by qid""",
    "io_parsed": """with r as (select line_no, json_extract_string(body, '$.id') id, json_extract(body, '$.nodes') ns from raw_subgraph where json_valid(body) and json_type(body) = 'OBJECT')
select line_no, id, (case json_type(ns) when 'ARRAY' then json_array_length(ns) when 'OBJECT' then len(json_keys(ns)) end)::int n_nodes from r""",
}
