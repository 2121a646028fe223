"""Plan inspection helpers: the physical plan as text and operator counts."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame

_OP = re.compile(r"^[\s:|+\-*()0-9]*([A-Z][A-Za-z]+)")


def physical_plan(df: DataFrame) -> str:
    """The (initial, adaptive) physical plan text -- no job is run."""
    return df._jdf.queryExecution().executedPlan().toString()


def operator_counts(plan_text: str) -> Counter:
    c: Counter = Counter()
    for line in plan_text.splitlines():
        m = _OP.match(line)
        if m:
            c[m.group(1)] += 1
    return c
