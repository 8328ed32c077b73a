"""Sinks: JSON lines, routed outputs, keyed documents, TSV, appending and guarded writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch


def json_lines(df: DataFrame, path: str, force: bool = False) -> None:
    """Fails if the output exists, unless forced."""
    df.write.mode("overwrite" if force else "errorifexists").option("ignoreNullFields", "false").json(path)


def routed(df: DataFrame, route: str, path: str) -> None:
    """One folder per value of ``route``, in one pass."""
    df.write.mode("overwrite").partitionBy(route).json(path)


#: Folders of a keyed sink, whatever the number of keys.
KEY_FOLDERS = 256


def keyed_documents(df: DataFrame, key: str, path: str) -> None:
    """Documents by ``key``, in folders by its hash: a look-up reads one folder, and millions of keys make no more of them."""
    df.withColumn("key_hash", F.pmod(F.xxhash64(key), F.lit(KEY_FOLDERS)).cast("int")).repartition("key_hash").write.mode("overwrite").partitionBy("key_hash").json(path)


def tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def append_undone(df: DataFrame, key: str, path: str) -> int:
    """Append the rows whose key the output does not hold yet; how many those are."""
    spark = df.sparkSession
    try:
        done = spark.read.schema(df.schema).json(path).select(key)
        new = df.join(done, key, "left_anti")
    except Exception as e:  # the output does not exist yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        new = df
    new = Scratch(spark, "append").cut(new)
    new.write.mode("append").json(path)
    return new.count()


def replace_in_place(df: DataFrame, path: str) -> None:
    """Overwrite a table that ``df`` itself reads: the rows are written elsewhere first."""
    Scratch(df.sparkSession, "replace").cut(df).write.mode("overwrite").parquet(path)
