"""The registered queries: each runs a library operator over the given tables, most
with the same question in plain SQL beside it.  Importing the modules registers them."""

from . import forests, graphs, models, relational, streams  # noqa: F401
from .registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
