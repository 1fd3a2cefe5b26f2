"""Queries and their SQL twins, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Decorator: file a query under a name, with its SQL where SQL can express it."""

    def put(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn

    return put


def _load() -> None:
    from terrafold.plans import catalogue  # noqa: F401


def all_queries() -> dict[str, Query]:
    _load()
    return _QUERIES


def all_oracles() -> dict[str, str]:
    _load()
    return _ORACLES
