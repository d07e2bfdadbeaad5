"""Registered queries: a callable over fixtures and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import Fixtures, oracle

Query = Callable[[Fixtures], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return register


def bound(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(Fixtures(spark, sf_dir))
