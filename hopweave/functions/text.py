"""Text functions as Column expressions: normal forms, token overlap, tiers, scores.

Words are runs of Unicode letters, numbers and underscores, lower-cased; everything
stays inside code generation, without Python workers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What lies between words.
GAP = r"[^\p{L}\p{N}_]+"
ARTICLES = ("a", "an", "the")
#: White space that is cut around a text. Spark's trim cuts ASCII blanks only.
SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0           　"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE))


def words(text: Column) -> Column:
    """Lower-case words in order; an empty list for null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


def match_form(text: Column) -> Column:
    """The form in which answers and labels are matched."""
    return F.array_join(words(text), " ")


def score_words(text: Column) -> Column:
    """Words without articles, as replies are scored."""
    return F.filter(words(text), lambda w: ~w.isin(*ARTICLES))


def score_form(text: Column) -> Column:
    return F.array_join(score_words(text), " ")


def jaccard(a: Column, b: Column) -> Column:
    """Shared distinct words over all distinct words; 0 where either list is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def fuzzy_score(a: Column, b: Column, threshold: float = 0.5) -> Column:
    """Of two match forms: above 0.5 where one holds the other (both of three letters or more),
    else the Jaccard share of words where it reaches ``threshold``, else 0."""
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    share = jaccard(F.filter(F.split(a, " "), lambda w: w != ""), F.filter(F.split(b, " "), lambda w: w != ""))
    return F.when((short >= 3) & (F.contains(a, b) | F.contains(b, a)), 0.5 + short / (long + 1)).when(share >= threshold, share).otherwise(F.lit(0.0))


def text_tier(answer: Column, text: Column, threshold: float = 0.5) -> Column:
    """``struct(tier, score)`` of one text: 1 equal but for case, 2 equal in match form, 3 similar, 4 not; null and empty texts are 4."""
    fuzzy = fuzzy_score(match_form(answer), match_form(text), threshold)
    tier = (
        F.when(text.isNull() | (text == ""), 4)
        .when(strip(F.lower(answer)) == strip(F.lower(text)), 1)
        .when(match_form(answer) == match_form(text), 2)
        .when(fuzzy > 0, 3)
        .otherwise(4)
    )
    return F.struct(tier.alias("tier"), F.when(tier < 3, F.lit(1.0)).when(tier == 3, fuzzy).otherwise(F.lit(0.0)).alias("score"))


def exact_match(reply: Column, aliases: Column) -> Column:
    """1.0 if the reply equals any alias in score form."""
    r = score_form(reply)
    return F.exists(aliases, lambda a: score_form(a) == r).cast("double")


def token_f1(reply: Column, aliases: Column) -> Column:
    """The largest F1 over the aliases: distinct shared words over the lengths with repeats; 0 for an empty side."""
    p = score_words(reply)

    def one(alias: Column) -> Column:
        g = score_words(alias)
        shared = F.size(F.array_intersect(p, g))
        precision, recall = shared / F.greatest(F.size(p), F.lit(1)), shared / F.greatest(F.size(g), F.lit(1))
        return F.when(shared > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))

    return F.coalesce(F.array_max(F.transform(aliases, one)), F.lit(0.0))


def hit(reply_id: Column, gold_id: Column) -> Column:
    """1.0 for equal ids but for blanks around them; null never hits."""
    return F.coalesce((strip(reply_id) == strip(gold_id)).cast("double"), F.lit(0.0))


def verdict(reply: Column) -> Column:
    """A judge's reply as a boolean: reasoning is cut, ``yes`` wins over ``no``; null where neither is said."""
    said = F.lower(F.regexp_replace(reply, r"(?s)<think>.*?</think>", ""))
    return F.when(F.contains(said, F.lit("yes")), True).when(F.contains(said, F.lit("no")), False)


def triple_text(s: Column, p: Column, o: Column) -> Column:
    return F.concat(F.lit("("), s, F.lit(") --["), p, F.lit("]--> ("), o, F.lit(")"))


def uri_tail(uri: Column) -> Column:
    return F.element_at(F.split(uri, "/"), -1)
