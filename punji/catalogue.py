"""Registered queries of the engine's own operators and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from punji.plans import archive_queries, article_queries  # noqa: F401  (both register their queries)


def entry(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: ranked article search over four columns."""
    return archive_queries.QUERIES["article_search_exact"](spark, sf)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(archive_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(archive_queries.SQL)
