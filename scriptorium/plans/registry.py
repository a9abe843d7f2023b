"""All queries of the library, each with the SQL that gives the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scriptorium.plans import document_queries, extraction_queries, file_queries, geometry_queries, layout_queries, text_queries

MODULES = (text_queries, geometry_queries, layout_queries, document_queries, extraction_queries, file_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: build for m in MODULES for name, (build, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
