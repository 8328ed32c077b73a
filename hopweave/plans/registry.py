"""All queries of the core, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..streaming import resume
from . import graph, io, kgqa, nested, pipeline

_MODULES = [nested, kgqa, graph, pipeline, io, resume]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
