"""Aggregates on money whose result does not depend on row order.

Summing doubles gives a last digit that changes with task order, and after
rounding even a whole cent. Money is therefore summed as decimals with four
places and given back as double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def money(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast(MONEY)


def money_sum(column: str | Column, places: int = 2) -> Column:
    return F.round(F.sum(money(column)), places).cast("double")


def money_avg(column: str | Column, places: int = 2) -> Column:
    return F.round(F.avg(money(column)), places).cast("double")


def share_pct(part: Column, whole: Column, places: int = 2) -> Column:
    """``part / whole`` in percent; NULL when ``whole`` is zero."""
    return F.round(F.try_divide(part, whole) * 100, places)


def clip01(column: Column) -> Column:
    """Limit to the range 0 to 1; NULL becomes 0, as ``greatest`` skips NULLs."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), column))
