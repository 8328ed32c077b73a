"""Problem 9: a mix in which each source has its target share of all tokens.

Method: a source's budget is spent on complete epochs first; what is left is a
fractional epoch, filled by Efraimidis-Spirakis sampling: documents in the order of
exponential keys divided by their quality weights, prefix-summed to the budget.
Prefix sums go over a histogram of the keys, so no task holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranks import BITS, running_total
from ..session import Scratch
from .bpe import VOCABULARY, count_tokens

#: Least quality weight of a document.
LEAST_WEIGHT = 0.2


#: Characters per word that running text has on the average, at least and at most.
WORD_LENGTHS = (2.5, 12.0)


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), "")


def quality(text: Column, words: Column, letters: Column) -> Column:
    """A weight from ``LEAST_WEIGHT`` to 1: the geometric mean of four shares.

    ``words`` is the ``word_list`` of the text and ``letters`` its number of letters and digits,
    as columns of their own, so that each is found once.  The shares: letters, digits and one
    blank per word among all characters; distinct words among all words, against what a text
    of that length has (about the 0.8th power of its words); words that are no numbers; and
    how far the mean word is from the lengths of running text (texts without blanks, such as
    Japanese, have no words to measure).
    """
    length = F.greatest(F.char_length(text), F.lit(1))
    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    mean = letters / n
    # Words of that mean length are sentences without blanks, if they are of many different characters.
    unspaced = (mean > WORD_LENGTHS[1]) & text.rlike(r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]{6}")
    kept = F.least(F.lit(1.0), (letters + F.size(words)) / length)
    varied = F.when(unspaced, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.size(F.array_distinct(words)) / F.pow(n, F.lit(0.8))))
    told = F.greatest(F.lit(0.0), 1 - F.regexp_count(text, F.lit(r"\b[0-9]+\b")) / n)
    usual = F.when(unspaced, F.lit(1.0)).otherwise(F.least(F.lit(1.0), mean / WORD_LENGTHS[0], WORD_LENGTHS[1] / F.greatest(mean, F.lit(0.1))))
    return F.greatest(F.lit(LEAST_WEIGHT), F.pow(kept * varied * told * usual, F.lit(0.25)))


def with_quality(documents: DataFrame, text: str = "text", out: str = "weight") -> DataFrame:
    """``documents`` with the quality weight of each text."""
    letters = F.char_length(F.regexp_replace(F.col(text), r"[^\p{L}\p{M}\p{N}]+", ""))
    found = documents.withColumns({"__words": word_list(F.col(text)), "__letters": letters})
    return found.withColumn(out, quality(F.col(text), F.col("__words"), F.col("__letters"))).drop("__words", "__letters")


def sized_documents(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Distinct ``(doc_id, source, tokens, weight)`` of documents with a source and at least one token."""
    base = with_quality(documents.where("source is not null and text is not null and text <> ''"))
    return count_tokens(base, ["doc_id", "source", "weight"], "text", vocabulary).where("tokens > 0").distinct()


def source_plan(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """Per listed source: what it has, its budget in tokens, its complete epochs and the budget that is left for a fractional one.

    ``targets`` has ``source, target_share, max_repeats``; shares of repeated sources add
    up, their largest ``max_repeats`` counts; a null share is 0, a null ``max_repeats`` is 1.
    Without ``total_tokens`` the mix is the largest in which every source that has
    documents can give its share.
    """
    wanted = targets.where("source is not null").groupBy("source").agg(F.sum(F.coalesce("target_share", F.lit(0.0))).alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats"))
    has = sized.groupBy("source").agg(F.count("*").alias("documents"), F.sum("tokens").alias("available"))
    plan = wanted.join(has, "source", "left").fillna(0, ["documents", "available"])
    if total_tokens is None:
        fits = F.min(F.when((F.col("available") > 0) & (F.col("target_share") > 0), F.col("available") * F.col("max_repeats") / F.col("target_share")))
        total = plan.agg(fits.alias("t")).first()["t"] or 0.0
    else:
        total = float(total_tokens)
    # A product of shares may miss a whole number of epochs by a rounding error.
    budget = F.lit(float(total)) * F.col("target_share")
    per_epoch = F.floor(budget / F.col("available") + 1e-9)
    epochs = F.when(F.col("available") > 0, F.least(per_epoch, F.col("max_repeats").cast("bigint"))).otherwise(0)
    plan = plan.withColumns({"budget": budget, "epochs": epochs.cast("bigint")})
    return plan.withColumn("rest", F.when(F.col("epochs") < F.col("max_repeats"), F.greatest(F.lit(0.0), F.col("budget") - F.col("epochs") * F.col("available"))).otherwise(0.0))


def mixed_documents(sized: DataFrame, plan: DataFrame, seed: int = 42) -> DataFrame:
    """``(doc_id, source, tokens, uses)`` of every document that the mix uses.

    The fractional epoch takes documents in key order while at least half of the next one fits.
    """
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(str(seed)), "doc_id"), 11).cast("double") + 0.5) / float(1 << 53)
    keyed = sized.withColumn("key", -F.log(u) / F.col("weight"))
    # Monotone in the key, and close to uniform: keys are exponential with rates from LEAST_WEIGHT to 1.
    keyed = keyed.withColumn("bucket", F.least(F.lit((1 << BITS) - 1), F.floor((1 - F.exp(-0.8 * F.col("key"))) * (1 << BITS))).cast("int"))
    joined = keyed.join(plan.select("source", "epochs", "rest"), "source")
    run = running_total(joined, ["source"], "bucket", ["key", "doc_id"], "tokens")
    extra = ((F.col("rest") > 0) & (F.col("run") - F.col("tokens") / 2 <= F.col("rest"))).cast("bigint")
    return run.select("doc_id", "source", "tokens", (F.col("epochs") + extra).cast("int").alias("uses")).where("uses > 0")


def mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 42, vocabulary: str = VOCABULARY) -> DataFrame:
    """The documents of the mix with the number of their uses, at most ``max_repeats`` of their source.

    Null, empty and unsourced documents and sources that no target names have no part.
    """
    sized = Scratch(documents.sparkSession, "mix").cut(sized_documents(documents, vocabulary))
    return mixed_documents(sized, source_plan(sized, targets, total_tokens), seed)


def mix_report(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 42, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per listed source: its target, its budget, the tokens and the share reached, and what is missing.

    A source without documents reaches 0 tokens; its whole budget is missing.
    """
    sized = Scratch(documents.sparkSession, "mix").cut(sized_documents(documents, vocabulary))
    plan = source_plan(sized, targets, total_tokens)
    used = mixed_documents(sized, plan, seed).groupBy("source").agg(F.count("*").alias("documents_used"), F.sum("uses").alias("uses"), F.sum(F.col("uses") * F.col("tokens")).alias("tokens_used"))
    out = plan.join(used, "source", "left").fillna(0, ["documents_used", "uses", "tokens_used"])
    # A window without partitions: its rows are the few sources that the targets name.
    out = out.withColumn("total", F.sum("tokens_used").over(Window.partitionBy(F.lit(1))))
    return out.select(
        "source",
        "target_share",
        "max_repeats",
        "documents",
        F.col("available").alias("tokens_available"),
        F.round("budget").cast("bigint").alias("tokens_wanted"),
        "documents_used",
        "uses",
        "tokens_used",
        F.when(F.col("total") > 0, F.col("tokens_used") / F.col("total")).otherwise(0.0).alias("share_reached"),
        F.greatest(F.lit(0), F.round("budget").cast("bigint") - F.col("tokens_used")).alias("tokens_missing"),
    )
