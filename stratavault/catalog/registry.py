"""Named queries over the test tables, each with the SQL that states its expected rows."""

from __future__ import annotations

from stratavault.catalog import (
    files_queries,
    publish_queries,
    quality_queries,
    relational_queries,
    storage_queries,
    stream_queries,
    typing_queries,
    vault_queries,
)
from stratavault.catalog.base import Query

MODULES = (vault_queries, relational_queries, typing_queries, stream_queries, files_queries, publish_queries, quality_queries, storage_queries)


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in MODULES:
        for name, query in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} is defined twice")
            found[name] = query
    return found
