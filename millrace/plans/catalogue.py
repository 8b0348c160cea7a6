"""All queries of this package by name, and the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions import scalar
from ..operators import relational
from ..sources import formats
from ..sources.tables import Tables
from ..streaming import events


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over_tables(f: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: f(Tables(spark, sf_dir))

    return {name: over_tables(f) for part in (relational, scalar, formats) for name, f in part.QUERIES.items()} | events.QUERIES


def oracle_sql() -> dict[str, str]:
    return relational.SQL | scalar.SQL | formats.SQL | events.SQL
