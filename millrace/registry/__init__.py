"""Registered queries: each runs an operator over whole test tables, most with an SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def all_queries() -> dict[str, Query]:
    from millrace.registry import lakes, streams, tables

    return {**tables.QUERIES, **lakes.QUERIES, **streams.QUERIES}
