"""Registered queries and the SQL each is compared with."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ESSAYS = """essays AS (
  SELECT d.doc_id AS id, d.text, d.source, d.lang AS prompt_name, d.n_chars, 1 - l.quality AS generated
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
GRADED = """graded AS (
  SELECT doc_id AS id, ((n_chars * 37) % 1001) / 1000.0::DOUBLE AS score_a, ((doc_id * 7919) % 997) / 996.0::DOUBLE AS score_b
  FROM documents)"""
SCORED = GRADED + """, scored AS (
  SELECT g.id, 1 - l.quality AS label, g.score_a AS score FROM labels l JOIN graded g ON g.id = l.doc_id)"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows if there is one."""

    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def load_all() -> None:
    """Import every module here, each of which registers its queries."""
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
