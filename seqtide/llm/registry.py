"""Queries of this package by name, each with its DuckDB text where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES = ("queries",)


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return add


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for name in MODULES:
        import_module(f"seqtide.llm.{name}")
    return dict(QUERIES), dict(ORACLES)
