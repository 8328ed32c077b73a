"""Views of the project's tables that several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Blanks that do not count around an id.
BLANKS = " \t\r\n "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean_id(col: str | Column) -> Column:
    """An id without blanks around it; null for a blank one."""
    c = F.col(col) if isinstance(col, str) else col
    cut = F.btrim(c, F.lit(BLANKS))
    return F.when(cut != "", cut)


def clean_ids(col: str | Column) -> Column:
    """The distinct ids of a list, in order of appearance, without blanks around them; null, blank and repeated ones count for nothing. A null list gives an empty one."""
    c = F.col(col) if isinstance(col, str) else col
    ids = F.filter(F.transform(c, clean_id), lambda x: x.isNotNull())
    return F.coalesce(F.array_distinct(ids), F.array().cast("array<string>"))
