"""Finding the node that an answer means, among the nodes of its question's graph."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def node_tiers(questions: DataFrame, nodes: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``id, node_ord, qid, tier, score`` of every node of each question's graph, tier 4 left out.

    The label counts before the description: where one of them is equal but for case the
    tier is 1, else the better tier counts, and the larger score of two similar ones.
    """
    j = questions.select("id", "answer").where("answer is not null").join(nodes.select("id", "node_ord", "qid", "label", "description"), "id")
    label, description = T.text_tier(F.col("answer"), F.col("label"), threshold), T.text_tier(F.col("answer"), F.col("description"), threshold)
    j = j.select("id", "node_ord", "qid", label.alias("l"), description.alias("d"))
    tier = F.least("l.tier", "d.tier")
    score = F.when(tier <= 2, 1.0).otherwise(F.greatest(F.when(F.col("l.tier") == 3, F.col("l.score")).otherwise(0.0), F.when(F.col("d.tier") == 3, F.col("d.score")).otherwise(0.0)))
    return j.select("id", "node_ord", "qid", tier.alias("tier"), score.alias("score")).where("tier < 4")


def answer_nodes(questions: DataFrame, nodes: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``id, tier, qid, candidates``: the first node of tier 1 or 2 in node order, else the best similar one, else tier 4."""
    tiers = node_tiers(questions, nodes, threshold)
    exact = F.min_by(F.struct("tier", "qid"), F.when(F.col("tier") <= 2, F.col("node_ord")))
    similar = F.min_by("qid", F.when(F.col("tier") == 3, F.struct(-F.col("score"), "node_ord")))
    found = tiers.groupBy("id").agg(exact.alias("e"), similar.alias("s"), F.count_if(F.col("tier") == 3).alias("similar"))
    has = F.col("e.tier") <= 2
    out = questions.select("id").join(found, "id", "left")
    return out.select("id", F.when(has, F.col("e.tier")).when(F.col("similar") > 0, 3).otherwise(4).alias("tier"), F.when(has, F.col("e.qid")).when(F.col("similar") > 0, F.col("s")).alias("qid"), F.when(has, 0).otherwise(F.coalesce("similar", F.lit(0))).cast("bigint").alias("candidates"))


def judged(candidates: DataFrame, judge: Callable[[str, str], bool]) -> DataFrame:
    """``id, rank, qid, verdict`` of ``id, rank, qid, answer, label``: what ``judge(answer, label)`` says.

    ``judge`` may ask a model; it runs in the executors, a batch of rows at a time.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            said = [bool(judge(a, b)) if a is not None and b is not None else False for a, b in zip(pdf.answer, pdf.label)]
            yield pd.DataFrame({"id": pdf.id, "rank": pdf["rank"], "qid": pdf.qid, "verdict": said})

    return candidates.select("id", "rank", "qid", "answer", "label").mapInPandas(run, "id string, rank int, qid string, verdict boolean")


def confirmed(verdicts: DataFrame) -> DataFrame:
    """``id, qid, rank`` of the first candidate of each question that was confirmed."""
    return verdicts.where("verdict").groupBy("id").agg(F.min(F.struct("rank", "qid")).alias("m")).select("id", "m.qid", "m.rank")


def routes(found: DataFrame, confirmed: DataFrame) -> DataFrame:
    """``id, route, reason, qid, tier`` of questions with ``id, tier, qid, has`` (null without a graph) and their confirmed candidates."""
    j = found.join(confirmed.select("id", F.col("qid").alias("c")), "id", "left")
    reason = F.when(F.col("has").isNull(), "no_subgraph").when(F.col("tier") == 4, "no_match").when((F.col("tier") == 3) & F.col("c").isNull(), "tier3_declined")
    qid = F.when(F.col("has").isNotNull(), F.when(F.col("tier") <= 2, F.col("qid")).when(F.col("tier") == 3, F.col("c")))
    return j.select("id", F.when(reason.isNull(), "found").otherwise("not_found").alias("route"), reason.alias("reason"), qid.alias("qid"), F.when(F.col("has").isNotNull(), F.col("tier")).alias("tier"))
