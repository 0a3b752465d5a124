"""The queries of this folder, and the SQL that checks them where there is one."""

from __future__ import annotations

from mailweir.llm import (
    cube_mix, license_templates, line_runs, link_trust, periodic_runs, piece_table, pu_quality,
    shuffle_shards, signature_tree, simhash, simple8b, token_align, winnow,
)

_MODULES = (
    cube_mix, simple8b, signature_tree, pu_quality, shuffle_shards, simhash, winnow, link_trust,
    license_templates, line_runs, periodic_runs, piece_table, token_align,
)

QUERIES = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
