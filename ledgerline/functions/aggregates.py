"""Aggregate expressions whose results do not depend on summation order.

A double ``avg`` gives a different last bit depending on how the rows are
split over tasks.  Summing a 2-decimal value as decimal is exact, so the
result is the same on 1 or 1000 executors, and equal to any other
engine that follows the same rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum(col: str | Column, scale: int = 2, precision: int = 18) -> Column:
    """Sum of a money column as ``decimal(precision, scale)``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(f"decimal({precision - 4},{scale})")).cast(f"decimal({precision},{scale})")


def exact_avg(col: str | Column, scale: int = 2) -> Column:
    """Average of a value with at most ``scale`` decimals, as double."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(f"decimal(14,{scale})")).cast("double") / F.count(c)


def money_sum(col: str | Column) -> Column:
    """Sum of an already-decimal money column, rounded to cents."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c).cast("decimal(18,2)")


def long_sum(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c).cast("bigint")


def revenue_column(df) -> str:
    """The line revenue column of a lineitem frame: exact integer
    micro-units when present (mapped test tables), else ``net_amount``."""
    return "net_micros" if "net_micros" in df.columns else "net_amount"


def revenue_sum(col: str) -> Column:
    """Sum of line revenue as ``decimal(18,2)``, rounded half-up once.

    Micro-units are summed as ``decimal(38,0)`` (long additions while the
    total fits, exact beyond) and divided by 10^6 once per group.
    """
    if col == "net_micros":
        return (F.sum(F.col(col).cast("decimal(38,0)")) / F.lit(1_000_000)).cast("decimal(18,2)")
    return money_sum(col)
