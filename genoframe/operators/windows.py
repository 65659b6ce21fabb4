"""Window operators: first-by, gap filling, ordered heads, running sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def _order(cols: Sequence) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in cols]


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence, ties: bool = False,
             tiebreak: Sequence[str] = ()) -> DataFrame:
    """WN-1 / WN-2: first row(s) per group by ``order`` (NULLs last).

    Without ties exactly one row per group is kept; ``tiebreak`` columns make the
    choice total.  Catalyst plans this as a WindowGroupLimit (partial top-1
    before the shuffle), so a hot group is cut down map-side.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(list(order) + list(tiebreak)))
    fn = F.rank() if ties else F.row_number()
    return df.withColumn("_rn", fn.over(w)).where(F.col("_rn") == 1).drop("_rn")


def head_by(df: DataFrame, keys: Sequence[str], order: str = "_row") -> DataFrame:
    """WN-3: first row per key in input order (an explicit ingest row number)."""
    return first_by(df, keys, [order])


def fill_down(df: DataFrame, keys: Sequence[str], order: Sequence, cols: Sequence[str]) -> DataFrame:
    """WN-4: carry the last non-null value forward within each group."""
    w = Window.partitionBy(*keys).orderBy(*_order(order)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def fill_up(df: DataFrame, keys: Sequence[str], order: Sequence, cols: Sequence[str]) -> DataFrame:
    """WN-5: carry the next non-null value backward within each group."""
    w = Window.partitionBy(*keys).orderBy(*_order(order)).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumns({c: F.first(c, ignorenulls=True).over(w) for c in cols})


def fill_downup(df: DataFrame, keys: Sequence[str], order: Sequence, cols: Sequence[str]) -> DataFrame:
    """WN-6: fill down, then fill the leading gap up (one sort for both frames)."""
    base = Window.partitionBy(*keys).orderBy(*_order(order))
    down = base.rowsBetween(Window.unboundedPreceding, 0)
    up = base.rowsBetween(0, Window.unboundedFollowing)
    return df.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(down),
                                         F.first(c, ignorenulls=True).over(up)) for c in cols})


def with_row(df: DataFrame, order: Sequence, name: str = "row", keys: Sequence[str] = ()) -> DataFrame:
    """WN-9: 1-based row number (only for bounded inputs when ``keys`` is empty)."""
    w = Window.partitionBy(*keys).orderBy(*_order(order)) if keys else Window.orderBy(*_order(order))
    return df.withColumn(name, F.row_number().over(w))


def running_sum(df: DataFrame, col: str, order: Sequence, name: str, keys: Sequence[str] = (),
                exclusive: bool = False, default=None) -> DataFrame:
    """WN-8 / WN-11: running sum in order; ``exclusive`` = lag(cumsum) with a default."""
    w = Window.partitionBy(*keys).orderBy(*_order(order)) if keys else Window.orderBy(*_order(order))
    frame = w.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    s = F.sum(col).over(frame)
    return df.withColumn(name, F.coalesce(s, F.lit(default)) if default is not None else s)


def group_count(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """WN-13: per-group row count on every row (aggregate + join: skew-safe)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return df.join(counts, list(keys))
