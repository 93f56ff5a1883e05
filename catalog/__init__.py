"""Registered queries and, where SQL can say the same, their oracle text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from placestats.fixtures import Tables, with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, needs: Sequence[str] = (), ctes: dict[str, str] | None = None):
    """Register a function of `Tables` as query `name`, with its oracle if there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = with_ctes(sql, list(needs), ctes)
        return fn

    return register


def load_all() -> None:
    from catalog import analysis, boards, cards, cleaning, clusters, incremental, places, scores, search, series, sources, texts  # noqa: F401
