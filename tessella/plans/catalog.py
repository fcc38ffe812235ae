"""All registered queries of the library with their DuckDB equivalents."""

from __future__ import annotations

from tessella.plans import caches, canvases, flows, merges, panels, shapes, sheets, styles, texts

_PARTS = (sheets, shapes, styles, canvases, texts, flows, merges, panels, caches)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
