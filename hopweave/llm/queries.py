"""The registered queries of this package and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, canonical, defects, grouping, leakage, lookalike, mixing, mojibake, sampling
from .records import table as _t


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.cross_split_pairs(_t(spark, d, "split_record"))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return leakage.overlap_report(_t(spark, d, "split_record"))


def p1_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Evaluation records that training texts repeat, with the share of the text that the best one covers."""
    return leakage.overlap_coverage(_t(spark, d, "split_record")).where("not train").select("id", "covered")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return sampling.short_categories(_t(spark, d, "split_record"), _t(spark, d, "sample_target"))


def p2_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.balanced_sample(_t(spark, d, "split_record"), _t(spark, d, "sample_target"))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return sampling.sample_report(_t(spark, d, "split_record"), _t(spark, d, "sample_target"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.found_values(_t(spark, d, "split_record"), _t(spark, d, "graph_node"), _t(spark, d, "prediction"))


def p3_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every value with its consistent form."""
    values = lookalike.field_values(_t(spark, d, "split_record"), _t(spark, d, "graph_node"), _t(spark, d, "prediction"))
    return lookalike.canonical_text(values, "value")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.canonical_values(_t(spark, d, "split_record"), _t(spark, d, "graph_node"), _t(spark, d, "ref_item")).where("ref_id is not null").select("field_name", "row_key", "ref_id").distinct()


def p4_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The values that denote no entry."""
    return canonical.canonical_values(_t(spark, d, "split_record"), _t(spark, d, "graph_node"), _t(spark, d, "ref_item")).where("ref_id is null").select("field_name", "row_key", "value")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return grouping.related_records(_t(spark, d, "split_record"), _t(spark, d, "split_target"))


def p5_splits(spark: SparkSession, d: str) -> DataFrame:
    return grouping.grouped_splits(_t(spark, d, "split_record"), _t(spark, d, "split_target"))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Per split and label: what the splits hold beside their targets."""
    return grouping.split_report(_t(spark, d, "split_record"), _t(spark, d, "split_target"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return defects.defective_replies(_t(spark, d, "prediction"), _t(spark, d, "split_record"), _t(spark, d, "documents"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_corpus(_t(spark, d, "documents"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(_t(spark, d, "documents"), _t(spark, d, "mix_target"))


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_report(_t(spark, d, "documents"), _t(spark, d, "mix_target"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.garbled_documents(_t(spark, d, "documents"))


def p10_restored(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its text, restored where that is possible."""
    return mojibake.restored_text(_t(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_report, p1_coverage, p2_found, p2_sample, p2_report, p3_found, p3_forms, p4_found, p4_unmatched, p5_found, p5_splits, p5_report, p6_found, p8_ids, p9_mix, p9_report, p10_found, p10_restored)
}

ORACLES: dict[str, str] = {
    "p2_found": """
with r as (select id, max(difficulty) difficulty, max(reasoning_type) reasoning_type, max(list_sort(list_distinct(list_transform(coalesce(matched_ontologies, []), lambda m: m.ont_id)))) o from split_record where id is not null group by id),
c as (
  select 'difficulty' dimension, difficulty category, count(*) n from r group by difficulty
  union all select 'reasoning_type', reasoning_type, count(*) from r group by reasoning_type
  union all select 'matched_ontologies', k, count(*) from (select unnest(o) k from r) group by k)
select distinct t.dimension, t.category from sample_target t left join c using (dimension, category)
where coalesce(n, 0) < greatest(min_rows, round(target_share * sample_rows, 6))""",
    "p5_found": """
with recursive
e0 as (
  select id, trim(q) e from (select id, unnest(entity_qids) q from split_record union all select id, answer_node_qid from split_record)
  where trim(q) <> '' and id is not null),
e as (select distinct id, e from e0),
pairs as (select distinct f.e a, e.e b from e join (select id, min(e) e from e group by id) f using (id)),
sym as (select a, b from pairs union select b, a from pairs),
reach(node, seed) as (
  select distinct a, a from sym
  union
  select s.b, r.seed from reach r join sym s on s.a = r.node where r.seed < s.b),
comp as (select node, min(seed) c from reach group by node),
g as (select distinct e.id, comp.c from e join comp on comp.node = e.e),
n as (select c, min(id) group_id from g group by c having count(*) > 1)
select g.id, n.group_id from g join n using (c)""",
}
