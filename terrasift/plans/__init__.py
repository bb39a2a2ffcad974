"""Queries over a folder of tables, with the SQL that they are checked against."""

from __future__ import annotations

from ..session import shipped
from . import core_problems, metric_queries, raster_queries, table_queries

MODULES = (core_problems, raster_queries, metric_queries, table_queries)
FLAGSHIP = "pipeline"


def queries() -> dict:
    return {k: shipped(v) for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in MODULES for k, v in m.ORACLE.items()}
