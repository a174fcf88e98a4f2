"""Queries by name, each with the SQL that says the same in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierline.plans.roles import Roles, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Roles], DataFrame]], Callable[[Roles], DataFrame]]:
    """Register a function of the role tables under name; sql may name role tables (see roles.SQL)."""

    def register(f: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Roles(spark, sf_dir))
        if sql:
            ORACLES[name] = oracle(sql)
        return f

    return register
