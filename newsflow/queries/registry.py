"""All registered queries, merged from the per-area modules."""

from __future__ import annotations

from newsflow.queries import clean, features, metrics, model, profile, sources, stream, updates

QUERIES: dict = {}
SQL: dict = {}

for _mod in (clean, profile, features, metrics, model, updates, sources, stream):
    QUERIES.update(_mod.QUERIES)
    SQL.update(_mod.SQL)
