"""Small helpers shared by the expression modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def lit_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def safe_div(num, den) -> Column:
    """num / den with a zero or NULL divisor giving NULL (never an error, never Inf)."""
    d = col_of(den)
    return col_of(num) / F.when(d != 0, d)
