"""Mergeable distinct counts and calendars against plain SQL forms."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import calendar, distinct


def _visits(spark, n=20_000):
    rng = random.Random(1)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(70)), rng.randrange(3000) if rng.random() > 0.01 else None) for _ in range(n)]
    rows += [(dt.date(2024, 2, 1), 1)] * 10_000  # a hot day of one visitor
    return spark.createDataFrame(rows, "day date, user long").repartition(7)


def test_rolled_up_state_is_near_the_exact_count(spark):
    df = _visits(spark)
    state = distinct.distinct_state(df, ["day"], "user")
    for key in ("month", "week", "year"):
        got = distinct.estimates(distinct.roll_up(state, [F.trunc("day", key).alias("p")]))
        exact = df.groupBy(F.trunc("day", key).alias("p")).agg(F.countDistinct("user").alias("n"), F.count("*").alias("all"))
        both = got.join(exact, "p").withColumn("ok", distinct.within(F.col("distinct"), F.col("n"))).collect()
        assert len(both) == exact.count() and all(r.ok and r.rows == r["all"] for r in both)


def test_merging_is_independent_of_deliveries(spark):
    df = _visits(spark)
    whole = distinct.distinct_state(df, ["day"], "user")
    parts = [distinct.distinct_state(df.where(F.pmod("user", F.lit(3)) == i), ["day"], "user") for i in range(3)]
    merged = distinct.merge(*parts, parts[0], keys=["day"])  # a delivery that comes twice changes no estimate
    a = {r.day: r["distinct"] for r in distinct.estimates(whole).collect()}
    b = {r.day: r["distinct"] for r in distinct.estimates(merged).collect()}
    assert a.keys() == b.keys() and all(abs(a[d] - b[d]) <= max(1, 0.05 * a[d]) for d in a)


def test_state_of_empty_and_null_groups(spark):
    empty = spark.createDataFrame([], "day date, user long")
    assert distinct.distinct_state(empty, ["day"], "user").count() == 0
    nulls = spark.createDataFrame([(None, 5), (None, None), (dt.date(2024, 1, 1), None)], "day date, user long")
    got = {r.day: (r["distinct"], r.rows) for r in distinct.estimates(distinct.distinct_state(nulls, ["day"], "user")).collect()}
    assert got == {None: (1, 2), dt.date(2024, 1, 1): (0, 1)}


@pytest.mark.parametrize("period", sorted(calendar.STEPS))
def test_periods_without_rows_are_zeros(spark, period):
    rng = random.Random(period)
    days = [dt.date(2019, 12, 25) + dt.timedelta(days=rng.randrange(900)) for _ in range(60)]
    rows = [(rng.choice(["a", "b", None]), d, rng.randrange(100)) for d in days] + [("c", dt.date(2020, 2, 29), 5), ("a", None, 1000), ("b", dt.date(2015, 6, 1), 1)]
    df = spark.createDataFrame(rows, "k string, d date, v int")
    got = calendar.fill_periods(df, "d", period, ["k"], {"n": F.count("*"), "v": F.sum("v")}).collect()

    def start(d):
        if period == "day":
            return d
        if period == "week":
            return d - dt.timedelta(days=d.weekday())
        month = {"month": d.month, "quarter": 3 * ((d.month - 1) // 3) + 1, "year": 1}[period]
        return dt.date(d.year, month, 1)

    def after(d):
        return start(d + dt.timedelta(days={"day": 1, "week": 7, "month": 31, "quarter": 95, "year": 366}[period]))

    want = {}
    for k in ("a", "b", "c", None):
        own = [(start(d), v) for x, d, v in rows if x == k and d]
        at = min(s for s, _ in own)
        while at <= max(s for s, _ in own):
            want[k, at] = (sum(s == at for s, _ in own), sum(v for s, v in own if s == at))
            at = after(at)
    assert {(r.k, r.period): (r.n, r.v) for r in got} == want and len(got) == len(want)
    assert any(n == 0 for n, _ in want.values())
    labels = [r.label for r in spark.createDataFrame(sorted({(p,) for _, p in want}), "p date").select(calendar.period_label(F.col("p"), period).alias("label")).collect()]
    assert sorted(labels) == sorted(set(labels)) and labels == sorted(labels)


def test_week_labels_at_the_turn_of_the_year(spark):
    days = [dt.date(2018, 12, 31), dt.date(2021, 1, 1), dt.date(2020, 12, 28), dt.date(2024, 2, 12)]
    got = [r[0] for r in spark.createDataFrame([(d,) for d in days], "d date").select(calendar.period_label(F.col("d"), "week")).collect()]
    assert got == ["2019-W01", "2020-W53", "2020-W53", "2024-W07"]
    with pytest.raises(ValueError):
        calendar.period_start(F.col("d"), "decade")


def test_calendar_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, d date, v int")
    assert calendar.fill_periods(df, "d", "month", ["k"], {"n": F.count("*")}).count() == 0
