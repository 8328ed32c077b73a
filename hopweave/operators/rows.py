"""Row operators: first and last rows per key, overlays, resuming, splitting, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import running_total


def first_rows(df: DataFrame, key: str, order: list[str], keep: list[str]) -> DataFrame:
    """One row per non-null ``key``: the first by ``order``. An aggregate, so hot keys combine map-side; no window is held."""
    kept = F.min_by(F.struct(*keep), F.struct(*order))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(kept.alias("__r")).select(key, *(F.col(f"__r.{c}").alias(c) for c in keep))


def last_rows(df: DataFrame, key: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """One row per key: the last by ``order``."""
    return df.groupBy(*key).agg(F.max_by(F.struct(*keep), F.struct(*order)).alias("__r")).select(*key, *(F.col(f"__r.{c}").alias(c) for c in keep))


def overlay(base: DataFrame, patch: DataFrame, key: str, value: str) -> DataFrame:
    """``key, value, origin``: the patch's value where it has the key, else the base's; origin is ``kept``, ``overridden`` or ``added``."""
    b, p = base.select(key, F.col(value).alias("__b"), F.lit(1).alias("__in_b")), patch.select(key, F.col(value).alias("__p"), F.lit(1).alias("__in_p"))
    origin = F.when(F.col("__in_p").isNull(), "kept").when(F.col("__in_b").isNull(), "added").otherwise("overridden")
    return b.join(p, key, "full_outer").select(key, F.when(F.col("__in_p").isNotNull(), F.col("__p")).otherwise(F.col("__b")).alias(value), origin.alias("origin"))


def undone(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not yet done."""
    return todo.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def stratified_split(df: DataFrame, key: str, stratum: Column, seed: int = 42, shares: tuple[float, float] = (0.7, 0.15)) -> DataFrame:
    """``key, stratum, split``: train, dev and test of every stratum, in md5 order of seed and key.

    Train and dev take their rounded share (half to even) but at least one row, test the
    rest; where they would take more than there is, all of the stratum trains.
    """
    base = df.select(key, stratum.alias("stratum"))
    keyed = base.withColumn("__md5", F.md5(F.concat_ws("|", F.lit(str(seed)), key)))
    sizes = base.groupBy("stratum").agg(F.count("*").alias("n"))
    train, dev = (F.greatest(F.lit(1), F.rint(F.col("n") * s).cast("bigint")) for s in shares)
    sizes = sizes.select("stratum", F.when(train + dev > F.col("n"), F.col("n")).otherwise(train).alias("t"), F.when(train + dev > F.col("n"), F.lit(0)).otherwise(dev).alias("d"))
    # The bucket of the md5's first digits is monotone in the md5 itself.
    ranked = rank_by_text(keyed, ["stratum"], "__md5", key).join(sizes, "stratum")
    split = F.when(F.col("rank") <= F.col("t"), "train").when(F.col("rank") <= F.col("t") + F.col("d"), "dev").otherwise("test")
    return ranked.select(key, "stratum", split.alias("split"))


def rank_by_text(df: DataFrame, group: list[str], text: str, tie: str) -> DataFrame:
    """Row numbers by a hexadecimal text, without a window over a whole group."""
    made = df.withColumn("__bucket", F.conv(F.substring(text, 1, 3), 16, 10).cast("int"))
    return running_total(made, group, "__bucket", [text, tie], None, "rank").drop("__bucket")


def sampled(df: DataFrame, key: str, size: int, forced: Column | None = None, seed: int = 42) -> DataFrame:
    """``size`` rows in hash order, forced ones first. The limit is the operator's purpose."""
    order = [F.when(forced, 0).otherwise(1)] if forced is not None else []
    return df.orderBy(*order, F.md5(F.concat_ws("|", F.lit(str(seed)), key)), key).limit(size)


def first_label(sources: list[DataFrame], key: str = "qid", label: str = "label") -> DataFrame:
    """``key, label, priority``: the label of the first source that has one; a blank label is none."""
    tagged = [s.select(key, label).where(F.trim(label) != "").withColumn("priority", F.lit(i)) for i, s in enumerate(sources)]
    every = tagged[0]
    for t in tagged[1:]:
        every = every.unionByName(t)
    return every.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct("priority", label)).alias("m")).select(key, F.col(f"m.{label}").alias(label), F.col("m.priority").alias("priority"))

