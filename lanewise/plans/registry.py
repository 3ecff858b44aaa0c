"""Name, Spark query and SQL twin of every registered query."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .standin import DUCKDB_PREFIX

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None = None, recursive: bool = False) -> None:
    """``sql`` may use the stand-in tables ``flights``, ``scored``, ``airports``,
    ``party_edges`` and ``parties``, or continue their WITH list by starting with a comma."""
    if name in _QUERIES:
        raise ValueError(f"query {name} registered twice")
    _QUERIES[name] = query
    if sql is not None:
        head = "WITH RECURSIVE " if recursive else "WITH "
        _ORACLES[name] = head + DUCKDB_PREFIX + sql


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
