"""Queries of the llm operators: name -> (Spark builder, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Builder, str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Builder) -> Builder:
        QUERIES[name] = (fn, sql)
        return fn

    return add
