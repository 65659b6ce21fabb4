"""Date parsing and duration expressions.

Durations are DOUBLE months/years using the average month and year lengths
(30.4375 and 365.25 days), never INTERVAL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from genoframe.functions.common import col_of

# Average month / year length in days; spreadsheet day zero.
DAYS_PER_MONTH = 30.4375
DAYS_PER_YEAR = 365.25
SERIAL_ORIGIN = "1899-12-30"
MAX_SERIAL = 2_958_465


def parse_dmy(c) -> Column:
    """FN-5: day-month-year with any non-digit separator; unparseable -> NULL."""
    norm = F.regexp_replace(F.trim(col_of(c)), r"[^0-9]+", "-")
    ok = norm.rlike(r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$")
    return F.when(ok, F.try_to_date(norm, "d-M-yyyy"))


def parse_date(c, fmt: str = "d/M/yyyy") -> Column:
    """FN-6: parse with an explicit pattern; failure -> NULL."""
    return F.try_to_date(col_of(c), fmt)


def serial_to_date(c) -> Column:
    """Spreadsheet serial day number -> DATE (origin 1899-12-30)."""
    n = col_of(c).try_cast("double")
    # NaN and numbers beyond any spreadsheet's calendar (year 9999) are no dates
    ok = n.isNotNull() & ~F.isnan(n) & (n >= -MAX_SERIAL) & (n <= MAX_SERIAL)
    return F.when(ok, F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), F.floor(F.when(ok, n)).cast("int")))


def parse_dmy_or_serial(c) -> Column:
    """FN-7: d-m-Y text, else a spreadsheet serial number."""
    return F.coalesce(parse_dmy(c), serial_to_date(c))


def months_between_avg(later, earlier, digits: int | None = 1) -> Column:
    """FN-8: (later - earlier) in average months, optionally rounded."""
    m = F.datediff(col_of(later), col_of(earlier)) / DAYS_PER_MONTH
    return F.round(m, digits) if digits is not None else m


def years_floor(later, earlier) -> Column:
    """FN-8: whole years between two dates (floor of average years)."""
    return F.floor(F.datediff(col_of(later), col_of(earlier)) / DAYS_PER_YEAR)


def within_months(value, measured, ref, months: float = 12) -> Column:
    """FN-9: keep ``value`` only if measured within ``months`` after ``ref``."""
    return F.when(F.datediff(col_of(measured), col_of(ref)) <= months * DAYS_PER_MONTH, col_of(value))
