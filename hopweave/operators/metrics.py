"""Scores of replies, over several dimensions in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def scored_replies(replies: DataFrame, records: DataFrame, dimensions: list[str]) -> DataFrame:
    """Replies joined to their records, with ``em``, ``f1`` and ``h1``; replies without a record are left out. A null reply counts as an empty one."""
    joined = replies.join(records, "id")
    gold = F.when(F.size("answer_aliases") > 0, F.col("answer_aliases")).otherwise(F.array("answer"))
    reply = F.coalesce("pred_answer", F.lit(""))
    return joined.select("pred_id", "id", *dimensions, T.exact_match(reply, gold).alias("em"), T.token_f1(reply, gold).alias("f1"), T.hit(F.col("pred_qid"), F.col("answer_node_qid")).alias("h1"))


def metric_report(scored: DataFrame, dimensions: list[str], any_qid: DataFrame | None = None) -> DataFrame:
    """``dimension, key, em, f1, h1, n`` for the whole and for each value of each dimension, by grouping sets.

    ``any_qid`` is one row with ``has_qid``: without any reply that names a node, h1 is null.
    """
    sets = [[], *([d] for d in dimensions)]
    grouped = scored.groupingSets([[F.col(c) for c in s] for s in sets], *(F.col(d) for d in dimensions)).agg(
        *(F.avg(m).alias(m) for m in ("em", "f1", "h1")), F.count("*").alias("n"), *(F.grouping(d).alias(f"__g_{d}") for d in dimensions)
    )
    name, key = F.lit("global"), F.lit("all")
    for d in dimensions:
        name = F.when(F.col(f"__g_{d}") == 0, F.lit(d)).otherwise(name)
        key = F.when(F.col(f"__g_{d}") == 0, F.coalesce(F.col(d), F.lit("none"))).otherwise(key)
    out = grouped.select(name.alias("dimension"), key.alias("key"), "em", "f1", "h1", "n")
    if any_qid is not None:
        one = any_qid.select(F.lit(0).alias("__one"), "has_qid")
        out = out.withColumn("__one", F.lit(0)).join(F.broadcast(one), "__one", "left").withColumn("h1", F.when(F.col("has_qid"), F.col("h1"))).drop("__one", "has_qid")
    return out


def report_lines(report: DataFrame) -> DataFrame:
    """``line_no, line`` of a report of ``metric_report``, by dimension and key; averages in per cent with one decimal."""
    # A window without partitions: its rows are the few values of the dimensions.
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("dimension", "key"))
    per_cent = lambda c: F.format_string("%.1f%%", F.round(F.col(c) * 100, 1))
    hits = F.when(F.col("h1").isNull(), "").otherwise(F.concat(F.lit(" H@1 "), per_cent("h1")))
    return report.select(place.alias("line_no"), F.concat("dimension", F.lit(" "), "key", F.lit(": n="), F.col("n").cast("string"), F.lit(" EM "), per_cent("em"), F.lit(" F1 "), per_cent("f1"), hits).alias("line"))


def context_type() -> Column:
    """What the context of a record holds: all of the reasoning, or part of it."""
    has_path = F.coalesce(F.size("supporting_paths") > 0, F.lit(False))
    return F.when(F.col("difficulty") == "traversal", "oracle_full").when((F.col("difficulty") == "entity_selection") & has_path, "oracle_full").otherwise("oracle_partial")


def share(part: Column, whole: Column) -> Column:
    """A percentage; 0 for an empty whole."""
    return F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))
