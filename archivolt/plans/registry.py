"""All queries of the core and their SQL twins."""

from __future__ import annotations

from archivolt.plans import captures, files, problems, problems_sql, quality, tables, trees

_PARTS = (captures.query, tables.query, trees.query, quality.query, files.query)

QUERIES = {**problems.QUERIES}
ORACLE = {**problems_sql.ORACLE}
for _part in _PARTS:
    QUERIES |= _part.queries
    ORACLE |= _part.oracle
