"""Every query by name, with the SQL its result is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from joulemart import queries_core, queries_generic, queries_models, queries_sources

Query = Callable[[SparkSession, str], DataFrame]

_GROUPS = (queries_core, queries_generic, queries_sources, queries_models)


def all_queries() -> dict[str, Query]:
    return {name: run for group in _GROUPS for name, (run, _) in group.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {
        name: sql for group in _GROUPS for name, (_, sql) in group.QUERIES.items() if sql is not None
    }
