"""Registry of queries: name -> (job over the given tables, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from detlake.plans.substrate import Tables, with_views

_REGISTRY: dict[str, tuple[Callable[[Tables], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(job: Callable[[Tables], DataFrame]):
        if name in _REGISTRY:
            raise ValueError(f"query {name!r} is registered twice")
        _REGISTRY[name] = (job, sql)
        return job
    return add


def jobs() -> dict[str, Callable]:
    def bind(job):
        return lambda spark, folder: job(Tables(spark, folder))
    return {name: bind(job) for name, (job, _) in _REGISTRY.items()}


def oracles() -> dict[str, str]:
    return {name: with_views(sql, once=True) for name, (_, sql) in _REGISTRY.items() if sql}
