"""All registered queries and their SQL oracles, collected from the per-area modules."""

from __future__ import annotations

from asrprep.plans import curation_queries, io_queries, lazy_queries, prep_queries

_MODULES = [curation_queries, prep_queries, io_queries, lazy_queries]


def queries() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict:
    out = {}
    for m in _MODULES:
        out.update(m.ORACLES)
    return out
