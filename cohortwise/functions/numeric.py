"""Numeric helpers that keep results engine-independent.

* Shares are computed in DOUBLE (``100.0`` would be DECIMAL in Spark).
* Gap multipliers are compared by exact integer cross-multiplication: with
  ``gap = lifetime / (n - 1)``, ``days > gap * k/100`` is
  ``100 * days * (n - 1) > k * lifetime`` for ``n > 1``. No rounding of the
  gap can flip a boundary customer.
* ``money`` rounds summed / averaged doubles to a fixed number of digits so
  that different summation orders (partial aggregation across partitions)
  give identical values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_DIGITS = 6


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def share_pct(part, whole, digits: int | None = 2) -> Column:
    v = _col(part).cast("double") * F.lit(100.0) / _col(whole).cast("double")
    return F.round(v, digits) if digits is not None else v


def exceeds_gap_multiple(days, lifetime, n, factor_pct: int | Column) -> Column:
    """``days > lifetime / (n - 1) * factor_pct / 100`` exactly; FALSE when
    ``n <= 1`` (no gap can be estimated) or any input is NULL."""
    d, life, cnt = _col(days).cast("long"), _col(lifetime).cast("long"), _col(n).cast("long")
    k = factor_pct if isinstance(factor_pct, Column) else F.lit(int(factor_pct))
    test = (cnt > 1) & (d * (cnt - 1) * 100 > k.cast("long") * life)
    return F.coalesce(test, F.lit(False))


def money(c, digits: int = MONEY_DIGITS) -> Column:
    return F.round(_col(c).cast("double"), digits)
