"""Registered queries: every operator on the given tables, with its SQL counterpart."""

from midyear.catalog import cohorts, layouts, lookups, models, pipelines, reports, scalars, shapes  # noqa: F401
from midyear.catalog.registry import ORACLES, QUERIES  # noqa: F401
