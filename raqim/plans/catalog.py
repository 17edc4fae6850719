"""All registered queries of the core, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from raqim.plans import crawl, search, web

FLAGSHIP = "site_overview"
_MODULES = (web, crawl, search)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in _MODULES for name, (f, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, (_, sql) in m.QUERIES.items() if sql}
