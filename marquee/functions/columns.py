"""Column expressions shared by the questions (all built-in, codegen'd)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model: the credit categories the questions treat as
# acting credits.
ACTING_CATEGORIES = ("actor", "actress")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_values(c: str | Column, values: Iterable[str]) -> Column:
    return col(c).isin(list(values))


def is_acting(category: str | Column = "category", categories: Iterable[str] = ACTING_CATEGORIES) -> Column:
    return in_values(category, categories)


def has_any(arr: str | Column, values: Iterable[str]) -> Column:
    """True when the array holds any of ``values`` (null array -> null, so a
    filter drops it, like ``array_contains``)."""
    vals = list(values)
    if len(vals) == 1:
        return F.array_contains(col(arr), vals[0])
    return F.arrays_overlap(col(arr), F.array(*[F.lit(v) for v in vals]))


def decade(year: str | Column) -> Column:
    """``floor(year / 10) * 10`` as bigint; null year -> null decade."""
    return F.floor(col(year) / 10) * 10


def list_text(arr: str | Column, sep: str = ",") -> Column:
    """Array back to its comma text (null array -> null)."""
    return F.array_join(col(arr), sep)
