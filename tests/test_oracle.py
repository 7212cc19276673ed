"""Every registered query equals its DuckDB oracle on the smallest test data."""

from __future__ import annotations

import datetime as dt
import decimal

import pytest

import __spark_entry__ as ent
from conftest import SF_SMALL
from ledgerline.plans.registry import all_oracle_sql, all_queries


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v != 0 else "0"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


NAMES = sorted(all_oracle_sql())


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(NAMES) and set(NAMES) <= set(ent.oracle_sql())


def test_entry_runs(spark):
    df = ent.entry(spark)
    rows = df.collect()
    assert df.columns == ["product_name", "category", "total_sold", "total_revenue", "unique_customers"]
    assert 0 < len(rows) <= 20


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = ent.queries()[name](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck(SF_SMALL).execute(ent.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _canon(cols, rows) == _canon(dcols, drows)
