"""Problem 4: freely typed values mapped to the entries of a reference list.

Method: token-level repair, then soft TF-IDF.  Every distinct token of the values is
joined to the reference vocabulary by edit distance: an equi-join of the strings that
both become by leaving out a few letters, verified by the true distance (swapped
neighbours count as one edit).  The vocabulary also holds neighbouring words written
together, and words that occur in several entries may be abbreviated; numbers are never
repaired.  A value is compared with the entries whose heavy words it holds: those
without which no score can reach the least one, so words of many entries pair nothing.
Soft TF-IDF is the cosine of both texts' word weights, where a repaired token counts by
its similarity; an entry that a value holds only in part needs nearly all of its weight.
What a value holds besides the entry (a year, "retired", "city of") weighs little where
it is common and rules the entry out where it is not.

Values are folded and handled once per distinct form, tokens once per distinct token.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .fold import fold

#: Letters from which on one and two edits are repaired.
ONE_EDIT, TWO_EDITS = 3, 6
#: Longest abbreviation, and the number of entries from which a word is general enough to be abbreviated.
SHORT, GENERAL = 4, 3
#: Least score of a match, and of one with an entry that is not held as a whole.
LEAST_SCORE, LEAST_PARTIAL = 0.45, 0.93


def edits_allowed(token: str) -> int:
    """Edits that are repaired in ``token``; none in what holds a digit."""
    return 0 if len(token) < ONE_EDIT or any(c.isdigit() for c in token) else 1 if len(token) < TWO_EDITS else 2


def shortened(token: str) -> list[str]:
    """``token`` with up to as many letters left out as edits are allowed."""
    found = level = {token}
    for _ in range(edits_allowed(token)):
        level = {t[:i] + t[i + 1 :] for t in level for i in range(len(t))}
        found = found | level
    return sorted(found)


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions, replacements and swaps of neighbours, each letter edited once."""
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], before[j - 2] + 1)
        before, last = last, row
    return last[-1]


def abbreviates(short: str, word: str) -> bool:
    """Whether ``short`` starts like ``word`` and keeps some of its letters in order."""
    rest = iter(word)
    return 0 < len(short) <= SHORT and len(short) < len(word) and short[0] == word[0] and all(c in rest for c in short)


def _fold_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"value": pdf.value, "folded": pdf.value.map(fold)})


def _shorten_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(t, v) for t in pdf.token for v in shortened(t)]
        yield pd.DataFrame(rows, columns=["token", "variant"])


def _verify_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for token, term in zip(pdf.token, pdf.term):
            n = edit_distance(token, term)
            if n <= min(edits_allowed(token), edits_allowed(term)):
                rows.append((token, term, n))
        yield pd.DataFrame(rows, columns=["token", "term", "edits"])


def _abbreviation_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(a, b, 1) for a, b in zip(pdf.token, pdf.term) if abbreviates(a, b)]
        yield pd.DataFrame(rows, columns=["token", "term", "edits"])


def reference_terms(reference: DataFrame) -> DataFrame:
    """``term, ref_id, entry, words, first, upto``: the words of every name and alias and words written
    together, with the entry's number of words and the places that the term covers."""
    names = reference.where("ref_id is not null").select("ref_id", F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("value")).where("value is not null").distinct()
    folds = names.select("value").distinct().mapInPandas(_fold_batches, "value string, folded string").where("folded <> ''")
    entries = names.join(folds, "value").select("ref_id", F.col("folded").alias("entry"), F.split("folded", " ").alias("w")).distinct()
    spans = F.flatten(F.transform(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.transform(F.sequence(i, F.size("w") - 1), lambda j: F.struct(i.alias("first"), j.alias("upto")))))
    at = entries.select("ref_id", "entry", "w", F.explode(spans).alias("s"))
    joined = F.array_join(F.slice("w", F.col("s.first") + 1, F.col("s.upto") - F.col("s.first") + 1), "")
    return at.select(joined.alias("term"), "ref_id", "entry", F.size("w").alias("words"), F.col("s.first").alias("first"), F.col("s.upto").alias("upto"))


def repairs(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """``token, term, edits``: what each distinct ``token`` may stand for."""
    vocabulary = terms.select("term").distinct()
    exact = tokens.join(vocabulary, F.col("token") == F.col("term")).select("token", "term", F.lit(0).alias("edits"))
    ours = tokens.select("token").where((F.length("token") >= ONE_EDIT) & ~F.col("token").rlike("[0-9]")).mapInPandas(_shorten_batches, "token string, variant string")
    theirs = vocabulary.withColumnRenamed("term", "token").mapInPandas(_shorten_batches, "token string, variant string").withColumnRenamed("token", "term")
    near = ours.join(theirs, "variant").select("token", "term").distinct().mapInPandas(_verify_batches, "token string, term string, edits int")
    general = terms.where("first = upto").groupBy("term").agg(F.countDistinct("entry").alias("n")).where(f"n >= {GENERAL}").select("term", F.substring("term", 1, 1).alias("initial"))
    short = tokens.where(F.length("token") <= SHORT).withColumn("initial", F.substring("token", 1, 1)).join(general, "initial").select("token", "term").mapInPandas(_abbreviation_batches, "token string, term string, edits int")
    # A word of the vocabulary abbreviates none.
    short = short.join(vocabulary, F.col("token") == vocabulary["term"], "left_anti")
    return exact.unionByName(near).unionByName(short).groupBy("token", "term").agg(F.min("edits").alias("edits"))


def heavy_terms(terms: DataFrame, weight: DataFrame) -> DataFrame:
    """``term, ref_id, entry``: the terms of each entry that cover one of its heavy places.

    Places are light as long as all light ones together weigh less than any match needs, so
    a match covers a heavy one.  ``weight`` has ``term, w``, the squared weight.
    """
    placed = terms.join(weight, "term")
    own = placed.where("first = upto").groupBy("ref_id", "entry").agg(F.array_sort(F.collect_list(F.struct("w", "first"))).alias("places"))
    total = F.aggregate("places", F.lit(0.0), lambda s, p: s + p["w"])
    below = lambda i: F.aggregate(F.slice("places", F.lit(1), i + 1), F.lit(0.0), lambda s, p: s + p["w"])
    heavy = F.transform(F.filter(F.transform("places", lambda p, i: F.struct(p["first"].alias("first"), below(i).alias("sum"))), lambda x: x["sum"] >= LEAST_PARTIAL**2 * total), lambda x: x["first"])
    found = placed.join(own.select("ref_id", "entry", heavy.alias("heavy")), ["ref_id", "entry"])
    return found.where(F.exists("heavy", lambda h: (h >= F.col("first")) & (h <= F.col("upto")))).select("term", "ref_id", "entry").distinct()


def match_values(values: DataFrame, reference: DataFrame, column: str = "value") -> DataFrame:
    """Distinct ``(value, ref_id, score)`` of the values that denote an entry of ``reference``.

    ``reference`` has ``ref_id, name, aliases``.  The best entry is taken, on a tie the
    smallest ``ref_id``.  Null values and values without letters and digits denote none;
    names and aliases that are null are skipped; an empty list matches nothing.
    """
    scratch = Scratch(values.sparkSession, "values")
    distinct = values.select(F.col(column).alias("value")).where("value is not null").distinct()
    folded = scratch.cut(distinct.mapInPandas(_fold_batches, "value string, folded string").where("folded <> ''"))
    forms = folded.select("folded").distinct()
    placed = forms.select("folded", F.posexplode(F.split("folded", " ")).alias("at", "token"))
    tokens = scratch.cut(placed.groupBy("token").agg(F.count("*").alias("df")))
    terms = scratch.cut(reference_terms(reference))
    fixed = scratch.cut(repairs(tokens, terms))
    n = float(folded.select("folded").distinct().count() + 1)
    weight = lambda df: F.pow(F.log(F.lit(n) / F.greatest(df, F.lit(1))), 2)
    # A repaired token weighs as much as the word that it stands for; all numbers that no entry holds weigh as one word.
    known = terms.select("term").distinct().join(tokens, F.col("term") == F.col("token"), "left").select("term", weight(F.coalesce("df", F.lit(1))).alias("w"))
    number = F.col("token").rlike("^[0-9]+$") & F.col("term").isNull()
    own = tokens.join(terms.select("term").distinct(), F.col("token") == F.col("term"), "left").withColumn("kind", F.when(number, F.lit("0")).otherwise(F.col("token")))
    kinds = own.groupBy("kind").agg(F.sum("df").alias("all"))
    own = own.join(kinds, "kind").select("token", weight(F.col("all")).alias("w"))
    weights = placed.join(own, "token").groupBy("folded").agg(F.collect_list(F.struct("at", "w")).alias("all"))
    read = scratch.cut(placed.join(fixed, "token").select("folded", "at", "term", "edits"))
    near = read.join(heavy_terms(terms, known), "term").select("folded", "ref_id", "entry").distinct()
    # A short word alone is too easily another one.
    hits = read.join(near, "folded").join(terms, ["term", "ref_id", "entry"]).where(f"edits = 0 or words > 1 or length(term) > {ONE_EDIT}").join(known, "term")
    found = hits.groupBy("folded", "ref_id", "entry", "words").agg(F.collect_list(F.struct("edits", "at", "first", "upto", "w", (1 - F.col("edits") / F.length("term")).alias("alike"))).alias("found"))
    # Each place of the entry takes its cheapest token.
    best = F.transform(F.sequence(F.lit(0), F.col("words") - 1), lambda p: F.array_min(F.filter("found", lambda x: (x["first"] <= p) & (x["upto"] >= p))))
    bare = terms.where("first = upto").join(known, "term").groupBy("ref_id", "entry").agg(F.array_sort(F.collect_list(F.struct("first", "w"))).alias("places"))
    full = found.withColumn("best", best).withColumn("used", F.array_compact(F.array_distinct("best"))).join(bare, ["ref_id", "entry"]).join(weights, "folded")
    missing = F.filter("places", lambda x: F.get("best", x["first"]).isNull())
    scored = full.withColumns(
        {
            "shared": F.aggregate("used", F.lit(0.0), lambda s, b: s + b["alike"] * b["w"]),
            "inside": F.aggregate("used", F.lit(0.0), lambda s, b: s + b["w"]),
            "lacks": F.aggregate(missing, F.lit(0.0), lambda s, x: s + x["w"]),
            "outside": F.aggregate(F.filter("all", lambda t: ~F.exists("used", lambda b: b["at"] == t["at"])), F.lit(0.0), lambda s, t: s + t["w"]),
            "whole": F.size(missing) == 0,
        }
    )
    score = F.col("shared") / F.greatest(F.sqrt((F.col("inside") + F.col("lacks")) * (F.col("inside") + F.col("outside"))), F.lit(1e-9))
    scored = scored.withColumn("score", score).where(F.col("score") >= F.when(F.col("whole"), LEAST_SCORE).otherwise(LEAST_PARTIAL))
    first = scored.groupBy("folded").agg(F.min(F.struct((-F.round("score", 9)).alias("s"), "ref_id")).alias("m"))
    return folded.join(first, "folded").select("value", F.col("m.ref_id").alias("ref_id"), (-F.col("m.s")).alias("score"))


def free_values(split_record: DataFrame, graph_node: DataFrame, reference: DataFrame) -> DataFrame:
    """Distinct ``(field_name, row_key, value)``: answers of all records, labels of the nodes of a listed class, descriptions of all nodes."""
    classes = reference.where("class_qid is not null").select(F.col("class_qid").alias("class")).distinct()
    answers = split_record.select(F.lit("answer").alias("field_name"), F.col("id").alias("row_key"), F.col("answer").alias("value"))
    descriptions = graph_node.select(F.lit("description").alias("field_name"), F.col("qid").alias("row_key"), F.col("description").alias("value"))
    labels = graph_node.select("qid", "label", F.explode("instance_of").alias("class")).join(classes, "class", "left_semi").select(F.lit("label").alias("field_name"), F.col("qid").alias("row_key"), F.col("label").alias("value"))
    return answers.unionByName(labels).unionByName(descriptions).where("row_key is not null and value is not null").distinct()


def canonical_values(split_record: DataFrame, graph_node: DataFrame, reference: DataFrame) -> DataFrame:
    """``(field_name, row_key, value, ref_id, score)`` of every value; ``ref_id`` and ``score`` are null where it denotes no entry."""
    values = free_values(split_record, graph_node, reference)
    return values.join(match_values(values, reference), "value", "left").select("field_name", "row_key", "value", "ref_id", "score")
