"""All queries of the core and their SQL."""

from __future__ import annotations

from docprep.plans import nested, replies, storage, tables

_MODULES = (tables, nested, storage, replies)

QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
