"""All registered queries of the access-analysis operators, with their SQL."""

from __future__ import annotations

from tractlake.plans import areas, domains, entities, matrices, operations, records, relations, scalars, spaces

MODULES = (scalars, relations, spaces, domains, operations, areas, entities, matrices, records)
QUERIES = {name: query for module in MODULES for name, query in module.BOOK.queries.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.BOOK.oracle.items()}
