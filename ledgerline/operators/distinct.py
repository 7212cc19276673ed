"""Distinct counts as stored, mergeable state.

A distinct count cannot be added up: the buyers of two days are not the sum
of both.  A sketch per day can be: days merge to weeks, months or a whole
year without reading the events again, late rows of a day merge into what is
there, and a state of a few KB a group stands for any number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A sketch of 2**12 cells: relative standard error 1.04 / 2**6, 1.6 percent, in 4 KB at most.
LG_CELLS = 12


def standard_error(lg_cells: int = LG_CELLS) -> float:
    return 1.04 / (1 << lg_cells) ** 0.5


def distinct_state(df: DataFrame, keys: list[str | Column], value: str, lg_cells: int = LG_CELLS) -> DataFrame:
    """One row per group: the keys, ``sketch`` of the distinct non-null values, ``rows``.

    Sketches are built inside the map tasks, so a shuffle carries one of them
    per group and task, however many rows a hot group has."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(value), F.lit(lg_cells)).alias("sketch"), F.count(F.lit(1)).alias("rows"))


def merge(*states: DataFrame, keys: list[str]) -> DataFrame:
    """States of the same groups as one: what was stored, and what came since."""
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return roll_up(out, keys)


def roll_up(state: DataFrame, keys: list[str | Column]) -> DataFrame:
    """State of coarser groups (or of the same ones), from state alone."""
    return state.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("rows").alias("rows"))


def estimates(state: DataFrame, out: str = "distinct") -> DataFrame:
    """The state's groups with their estimated distinct counts."""
    return state.withColumn(out, F.hll_sketch_estimate("sketch")).drop("sketch")


def within(estimate: Column, exact: Column, lg_cells: int = LG_CELLS, deviations: float = 4) -> Column:
    """Is an estimate as near as so many standard errors (and one) allow?"""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), F.lit(deviations * standard_error(lg_cells)) * exact)
