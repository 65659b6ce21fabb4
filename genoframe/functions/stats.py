"""Scalar statistics used by the result tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from genoframe.functions.common import col_of


def neg_log10(p) -> Column:
    """FN-17: -log10(p); p = 0 (an underflowed p) -> Infinity, p < 0 -> NULL."""
    x = col_of(p)
    return F.when(x == 0, F.lit(float("inf"))).otherwise(-F.log10(F.when(x > 0, x)))


def log2(x) -> Column:
    """FN-17: log2 of a positive ratio (odds ratio)."""
    v = col_of(x)
    return F.log2(F.when(v > 0, v))


def capped(x, cap) -> Column:
    """FN-17: pmin(x, cap) with NULL-skipping semantics of least()."""
    return F.least(col_of(x), col_of(cap))
