"""Queries over the given tables, each with the SQL that checks it where there is one."""

from __future__ import annotations

from mailweir.registry import bodies, collections, flows, profiling, screening, streams

_GROUPS = (profiling, collections, screening, bodies, flows, streams)

QUERIES = {name: run for group in _GROUPS for name, run in group.QUERIES.items()}
ORACLE = {name: sql for group in _GROUPS for name, sql in group.ORACLE.items()}
