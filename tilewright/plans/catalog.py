"""Queries of the engine's own operators, with the SQL that must give the same rows."""

from __future__ import annotations

from tilewright.plans import more_queries, pixel_queries, record_queries, tile_queries

_MODULES = (tile_queries, record_queries, pixel_queries, more_queries)
QUERIES: dict = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL: dict = {name: text for m in _MODULES for name, text in m.ORACLE_SQL.items()}
FLAGSHIP = "tile_summary"
