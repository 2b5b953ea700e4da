"""All registered queries and the SQL that states the same result."""

from __future__ import annotations

from sluiceway.registry import expressions, files, jobs, models, slices

_MODULES = (expressions, slices, files, jobs)

QUERIES = dict(models.MODELS)
SQL = dict(models.MODEL_SQL)
for _module in _MODULES:
    QUERIES.update(_module.QUERIES)
    SQL.update(_module.SQL)
