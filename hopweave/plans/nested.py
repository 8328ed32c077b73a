"""Queries of problem 7 (nested records as flat tables) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dewey


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return dewey.nested_links(_t(spark, d, "subgraph"), _t(spark, d, "raw_subgraph"), _t(spark, d, "split_record"))


def p7_nodes(spark: SparkSession, d: str) -> DataFrame:
    """The flat table of nodes: one row per element of ``nodes``, with its label."""
    t = dewey.dewey_table(_t(spark, d, "subgraph"), ["id", "stage"], "nodes", "nodes[]")
    return t.select("id", "stage", "dewey", "ordinal", "qid", "label", "description")


def p7_node_props(spark: SparkSession, d: str) -> DataFrame:
    """The flat table of property values, joined to their entries by truncated labels."""
    g = dewey.content_key(_t(spark, d, "subgraph").select("id", "stage", F.transform("nodes", lambda n: F.struct(n["props"].alias("props"))).alias("nodes")), ["id", "stage"], "nodes")
    keys = ["__h1", "__h2", "id", "stage"]
    # Entries of repeated rows are equal, so each is taken once; values stay as they are.
    entry = dewey.dewey_table(g, keys[:2], "nodes", "nodes[].props{}").groupBy(*keys[:2], F.col("dewey").alias("parent")).agg(F.first("key").alias("pid"))
    value = dewey.dewey_table(g, keys, "nodes", "nodes[].props{}[]").select(*keys, "dewey", "parent", "ordinal", "value")
    return value.join(entry, [*keys[:2], "parent"]).select("id", "stage", "parent", "dewey", "ordinal", "value", "pid")


_EXTRA = {"nodes[].extra_props{}": {"pid": lambda v, k: k}}


def p7_extra_props(spark: SparkSession, d: str) -> DataFrame:
    """The flat table of extra property values; ``parent`` is the entry's label, and that without its last ordinal the node's."""
    t = dewey.dewey_table(_t(spark, d, "subgraph"), ["id", "stage"], "nodes", "nodes[].extra_props{}[]", _EXTRA)
    return t.select("id", "stage", "dewey", "parent", "ordinal", "value", "pid")


def p7_raw_extra_props(spark: SparkSession, d: str) -> DataFrame:
    """The flat table of extra property values of subgraphs that exist as JSON text, with the line that holds them."""
    g = dewey.parse_subgraphs(_t(spark, d, "raw_subgraph"), keep=["line_no"])
    t = dewey.dewey_table(g, ["line_no", "id"], "nodes", "nodes[].extra_props{}[]", _EXTRA)
    return t.select("line_no", "id", "dewey", "parent", "ordinal", "value", "pid")


def p7_paths(spark: SparkSession, d: str) -> DataFrame:
    """The flat table of supporting paths."""
    t = dewey.dewey_table(_t(spark, d, "split_record"), ["id", "split"], "supporting_paths", "supporting_paths[]")
    return t.select("id", "split", "dewey", "ordinal", "length")


def p7_path_triples(spark: SparkSession, d: str) -> DataFrame:
    """The flat table of the triples of supporting paths; ``parent`` is the path's label."""
    parts = {"supporting_paths[].triples[]": {c: (lambda v, k, i=i: F.get(v, F.lit(i))) for i, c in enumerate(("source_qid", "pid", "target_qid"))}}
    t = dewey.dewey_table(_t(spark, d, "split_record"), ["id", "split"], "supporting_paths", "supporting_paths[].triples[]", parts)
    return t.select("id", "split", "dewey", "parent", "ordinal", "source_qid", "pid", "target_qid")


QUERIES = {f.__name__: f for f in (p7_found, p7_nodes, p7_node_props, p7_extra_props, p7_raw_extra_props, p7_paths, p7_path_triples)}

ORACLES = {
    "p7_found": r"""
with n as (select id, unnest(nodes) n from subgraph),
e as (select id, n.qid s, unnest(map_entries(n.extra_props)) e from n),
x as (select id, s, e.key pid, unnest(e.value) t from e),
r0 as (select json_extract_string(body,'$.id') id, json_extract(body,'$.nodes') ns from raw_subgraph where json_valid(body)),
rn as (select r0.id, j.key k, j.value v, json_type(ns) ty from r0, json_each(ns) j),
re as (select rn.id, coalesce(json_extract_string(v,'$.qid'), case when ty='OBJECT' then k end) s, p.key pid, p.value pv from rn, json_each(json_extract(v,'$.extra_props')) p),
rx as (select re.id, s, pid, json_extract_string(q.value,'$') t from re, json_each(case when json_type(pv)='ARRAY' then pv else json_array(pv) end) q),
p as (select id, unnest(supporting_paths) p from split_record),
tr as (select id, unnest(p.triples) t from p),
a as (
  select 'extra' link_kind, id, trim(s) source_qid, trim(pid) pid, trim(t) target_qid from x
  union all select 'extra', id, trim(s), trim(pid), trim(t) from rx
  union all select 'path', id, trim(t[1]), trim(t[2]), trim(t[3]) from tr)
select distinct link_kind, id, source_qid, pid, target_qid from a where source_qid<>'' and pid<>'' and target_qid<>'' and id is not null""",
    "p7_nodes": """
with g as (select id, stage, nodes, unnest(range(len(nodes))) i from subgraph)
select id, stage, cast(i as varchar) dewey, cast(i as int) ordinal, nodes[i+1].qid qid, nodes[i+1].label label, nodes[i+1].description description from g""",
    "p7_node_props": """
with g as (select id, stage, nodes, unnest(range(len(nodes))) i from subgraph),
e as (select id, stage, i, map_entries(nodes[i+1].props) es from g),
e2 as (select id, stage, i, es, unnest(range(len(es))) j from e),
v as (select id, stage, i, j, es[j+1].key pid, es[j+1].value vs, unnest(range(len(es[j+1].value))) k from e2)
select id, stage, i||'.'||j parent, i||'.'||j||'.'||k dewey, cast(k as int) ordinal, vs[k+1] "value", pid from v""",
    "p7_extra_props": """
with g as (select id, stage, nodes, unnest(range(len(nodes))) i from subgraph),
e as (select id, stage, i, map_entries(nodes[i+1].extra_props) es from g),
e2 as (select id, stage, i, es, unnest(range(len(es))) j from e),
v as (select id, stage, i, j, es[j+1].key pid, es[j+1].value vs, unnest(range(len(es[j+1].value))) k from e2)
select id, stage, i||'.'||j parent, i||'.'||j||'.'||k dewey, cast(k as int) ordinal, vs[k+1] "value", pid from v""",
    "p7_raw_extra_props": r"""
with r as (select line_no, json_extract_string(body,'$.id') id, json_extract(body,'$.nodes') ns from raw_subgraph where json_valid(body) and json_type(body)='OBJECT'),
n0 as (select line_no, id, case when json_type(ns)='OBJECT' then json_transform(ns, '"MAP(VARCHAR, JSON)"') end m, case when json_type(ns)='ARRAY' then json_transform(ns, '["JSON"]') end l from r),
n1 as (select line_no, id, coalesce(map_values(m), l) vs from n0),
n as (select line_no, id, vs, unnest(range(len(vs))) i from n1),
x as (select line_no, id, i, json_extract(vs[i+1],'$.extra_props') x from n),
e as (select line_no, id, i, map_entries(json_transform(x, '"MAP(VARCHAR, JSON)"')) es from x where json_type(x)='OBJECT'),
e2 as (select line_no, id, i, es, unnest(range(len(es))) j from e),
p as (select line_no, id, i, j, es[j+1].key pid, es[j+1].value pv from e2),
v0 as (select line_no, id, i, j, pid, case when json_type(pv)='ARRAY' then json_transform(pv, '["VARCHAR"]') else [json_extract_string(pv,'$')] end vs from p where pv is not null and json_type(pv) <> 'NULL'),
v as (select line_no, id, i, j, pid, vs, unnest(range(len(vs))) k from v0)
select line_no, id, i||'.'||j parent, i||'.'||j||'.'||k dewey, cast(k as int) ordinal, vs[k+1] "value", pid from v""",
    "p7_paths": """
with p as (select id, split, supporting_paths sp, unnest(range(len(supporting_paths))) i from split_record)
select id, split, cast(i as varchar) dewey, cast(i as int) ordinal, sp[i+1].length length from p""",
    "p7_path_triples": """
with p as (select id, split, supporting_paths sp, unnest(range(len(supporting_paths))) i from split_record),
t as (select id, split, i, sp[i+1].triples ts, unnest(range(len(sp[i+1].triples))) j from p)
select id, split, cast(i as varchar) parent, i||'.'||j dewey, cast(j as int) ordinal, ts[j+1][1] source_qid, ts[j+1][2] pid, ts[j+1][3] target_qid from t""",
}
