"""Registered queries: one Spark builder per operator plus its DuckDB oracle.

Every builder takes ``(spark, sf_dir)`` and reads the driver tables through
the fixture volumes, so its work grows with the tables.  Oracles are written
independently in SQL (``tessera.sqlcheck``).  Column names and types match.
"""

from __future__ import annotations

import functools
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from .session import ensure_checkpoint_dir, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


from . import catalog_parts  # noqa: E402,F401  (registers the queries)
