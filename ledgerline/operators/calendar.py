"""Time series as a calendar: every period of a series has a row, also those without data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Period -> step between the first days of two periods.
STEPS = {"day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month", "quarter": "interval 3 months", "year": "interval 1 year"}


def period_start(date: Column, period: str) -> Column:
    """First day of the period that a date lies in (weeks begin on Monday)."""
    if period not in STEPS:
        raise ValueError(f"unknown period {period!r}; expected one of {sorted(STEPS)}")
    return date.cast("date") if period == "day" else F.trunc(date, period)


def spine(sums: DataFrame, keys: list[str], out: str, period: str) -> DataFrame:
    """One row per key and period, from the key's first to its last in ``sums``.

    Made from one row per key, by ``sequence`` and ``explode``: no join, and
    no key's calendar depends on another's."""
    span = sums.groupBy(*keys).agg(F.min(out).alias("_first"), F.max(out).alias("_last"))
    days = F.sequence("_first", "_last", F.expr(STEPS[period]))
    return span.select(*keys, F.explode(days).alias(out))


def fill_periods(df: DataFrame, date: str, period: str, keys: list[str], sums: dict[str, Column], out: str = "period") -> DataFrame:
    """Sums per key and period, with a row of zeros for every period in which a key has none.

    ``sums`` are aggregates by name; missing ones are 0 of their own type.
    Rows without a date belong to no period.  A null key is a key.
    """
    dated = df.where(F.col(date).isNotNull())
    found = dated.groupBy(*keys, period_start(F.col(date), period).alias(out)).agg(*[c.alias(n) for n, c in sums.items()])
    # calendar rows join the sums as zeros: a union and one more sum, so null keys meet as well
    zeros = spine(found, keys, out, period).select(*keys, out, *[F.lit(0).cast(found.schema[n].dataType).alias(n) for n in sums])
    both = found.unionByName(zeros).groupBy(*keys, out)
    return both.agg(*[F.sum(n).cast(found.schema[n].dataType).alias(n) for n in sums])


def period_label(date: Column, period: str) -> Column:
    """``1998``, ``1998-Q2``, ``1998-05``, ``1998-W07`` (ISO year and week) or ``1998-05-01``: text that sorts by time."""
    year, pad = F.year(date).cast("string"), lambda c: F.lpad(c.cast("string"), 2, "0")
    if period == "year":
        return year
    if period == "quarter":
        return F.format_string("%s-Q%d", year, F.quarter(date))
    if period == "month":
        return F.format_string("%s-%s", year, pad(F.month(date)))
    if period == "week":
        return F.format_string("%d-W%s", F.extract(F.lit("YEAROFWEEK"), date), pad(F.weekofyear(date)))
    return F.date_format(date, "yyyy-MM-dd")
