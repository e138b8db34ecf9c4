"""Date arithmetic with warehouse semantics, expressed as built-in columns.

* ``day_diff(a, b)``   = number of day boundaries from a to b (DATE inputs), BIGINT
* ``month_diff(a, b)`` = number of month *boundaries* crossed from a to b:
  2024-01-31 -> 2024-02-01 is 1. Spark's ``datediff(MONTH, ...)`` counts
  complete months instead, so it is not used.
* ``month_start(d)``   = first day of the month as a DATE (``trunc``), where
  ``date_trunc`` would return a TIMESTAMP.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_lit(d) -> Column:
    """A DATE literal from a ``date`` or an ISO string."""
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def to_day(c) -> Column:
    return F.to_date(_col(c))


def day_diff(start, end) -> Column:
    return F.datediff(_col(end), _col(start)).cast("long")


def month_diff(start, end) -> Column:
    s, e = _col(start), _col(end)
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("long")


def month_start(c) -> Column:
    return F.trunc(_col(c), "MM")
