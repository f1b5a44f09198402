"""All queries of the core and their SQL, by name."""

from __future__ import annotations

from . import artifacts, exports, ingest, relational, retrieval, text, wiki

MODULES = [artifacts, text, relational, exports, ingest, retrieval, wiki]


def queries():
    found = {}
    for m in MODULES:
        found |= m.queries()
    return found


def oracle_sql():
    found = {}
    for m in MODULES:
        found |= getattr(m, "oracle_sql", dict)()
    return found
