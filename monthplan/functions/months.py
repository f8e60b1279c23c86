"""Month helpers.

The plan works on month starts (``DateType``, day 1).  Validity intervals are half open, ``[start, end)``.
The plan calendar is the only table ever collected to the driver: it holds one row per plan month, so its size is
bounded by the horizon, not by the data.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_date(year: str | Column, month: str | Column) -> Column:
    """First day of a month from whole-number year and month columns."""
    return F.make_date(F.col(year) if isinstance(year, str) else year,
                       F.col(month) if isinstance(month, str) else month, F.lit(1))


def days_in_next_month(col: str | Column) -> Column:
    """Number of days of the month after ``col``'s month."""
    c = F.col(col) if isinstance(col, str) else col
    return F.dayofmonth(F.last_day(F.add_months(F.trunc(c, "month"), 1)))


def plan_months(calendar: DataFrame, col: str = "dt") -> list[_dt.date]:
    """Collect the plan months (oldest first) and check that they are contiguous.

    Stock is carried by ``dt + 1 month``; a gap in the calendar would orphan the carried stock.
    """
    months = sorted(r[0] for r in calendar.select(col).distinct().collect())
    for a, b in zip(months, months[1:]):
        nxt = (a.replace(day=1) + _dt.timedelta(days=32)).replace(day=1)
        if b != nxt:
            raise ValueError(f"plan calendar is not contiguous: {a} is followed by {b}")
    return months


def months_literal(months: Sequence[_dt.date]) -> Column:
    """The plan months as an ``array<date>`` literal (bounded by the horizon)."""
    return F.array(*[F.lit(m) for m in months]) if months else F.array().cast("array<date>")


def expand_to_months(df: DataFrame, months: Sequence[_dt.date], start: str, end: str,
                     end_shift: int = 0, out: str = "dt") -> DataFrame:
    """Interval-contains join with the plan calendar, without a join.

    Every row of ``df`` is repeated once per plan month ``m`` with ``start <= m < end + end_shift months``.
    The calendar is a literal array, so this is a narrow (shuffle-free) explode; reversed or empty intervals give
    no rows.
    """
    lo = F.col(start)
    hi = F.add_months(F.col(end), end_shift) if end_shift else F.col(end)
    inside = F.filter(months_literal(months), lambda m: (m >= lo) & (m < hi))
    return df.withColumn(out, F.explode(inside))
