"""All registered queries."""

from __future__ import annotations

from quarterdeck.workloads import (
    audit_queries,
    formula_queries,
    panel_queries,
    reshaping,
    scalars,
    scans,
    sink_queries,
)

MODULES = (scans, sink_queries, reshaping, panel_queries, audit_queries, scalars, formula_queries)
QUERIES = {name: entry for module in MODULES for name, entry in module.QUERIES.items()}
