"""Value maps and ordered domains as CASE expressions (they stay in codegen)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _case(c: Column, mapping: Mapping, other: Column) -> Column:
    out = None
    for old, new in mapping.items():
        hit = c == F.lit(old)
        out = F.when(hit, F.lit(new)) if out is None else out.when(hit, F.lit(new))
    return other if out is None else out.otherwise(other)


def recode(c: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """Mapped value, else ``default`` (the value itself when not given); NULL stays NULL
    unless a default is given."""
    return _case(c, mapping, c if default is None else default)


def recode_known(c: Column, mapping: Mapping) -> Column:
    """Mapped value; anything else, NULL included, is NULL."""
    return _case(c, mapping, F.lit(None))


def ordinal(c: Column, levels: Sequence[str]) -> Column:
    """1-based position in an ordered domain; unknown labels are NULL."""
    return _case(c, {label: i for i, label in enumerate(levels, start=1)}, F.lit(None))


def in_domain(c: Column, levels: Sequence[str]) -> Column:
    """The label itself if it belongs to the domain, else NULL."""
    return F.when(c.isin(list(levels)), c)


def if_else(test: Column, yes: Column, no: Column) -> Column:
    """Two-way choice; a NULL test gives NULL, not ``no``."""
    return F.when(test, yes).when(~test, no)
