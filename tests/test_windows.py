"""Skew-safe ranking, top-k, sessions and funnels equal the plain SQL windows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import windows
from ledgerline.plans import usecases


@pytest.fixture()
def skewed_events(spark):
    """User 0 holds a third of all events; gaps of exactly 30 minutes appear."""
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    rows, eid = [], 0
    for user in range(30):
        n = 600 if user == 0 else 20
        t = base + dt.timedelta(minutes=rnd.randint(0, 600))
        for _ in range(n):
            step = rnd.choice([1, 5, 29, 30, 31, 45, 200]) * 60 + rnd.choice([0, 0, 1])
            t = t + dt.timedelta(seconds=step)
            eid += 1
            rows.append((eid, user, t, rnd.choice(["view", "click", "purchase", "other"])))
    # Two events at the same instant for one user (tie broken by id).
    rows.append((eid + 1, 3, rows[-1][2], "view"))
    return spark.createDataFrame(rows, "event_id long, customer_id long, event_timestamp timestamp_ntz, "
                                       "event_type string")


def test_sessionize_equals_sql(spark, skewed_events):
    skewed_events.createOrReplaceTempView("ev")
    expected = spark.sql("""
        SELECT event_id, SUM(s) OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id
                                      ROWS UNBOUNDED PRECEDING) AS session_no
        FROM (SELECT *, CASE WHEN prev IS NULL OR event_timestamp - prev > INTERVAL 30 MINUTES THEN 1 ELSE 0 END AS s
              FROM (SELECT *, LAG(event_timestamp) OVER (PARTITION BY customer_id
                                                          ORDER BY event_timestamp, event_id) AS prev FROM ev))""")
    for bucket in (600, 3600, 86400):
        got = windows.sessionize(skewed_events, "customer_id", "event_timestamp", "event_id",
                                 1800, bucket_seconds=bucket).select("event_id", "session_no")
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_global_ntile_and_row_number(spark):
    # A value shared by a third of the rows.
    rows = [(i, 7.0 if i % 3 == 0 else float(i % 101)) for i in range(3001)]
    df = spark.createDataFrame(rows, "id long, v double")
    df.createOrReplaceTempView("nt")
    for k in (1, 4, 7):
        expected = spark.sql(f"SELECT id, ntile({k}) OVER (ORDER BY v, id) AS tile FROM nt")
        got = windows.global_ntile(df, ["v", "id"], k, num_partitions=5).select("id", F.col("tile").cast("int"))
        assert got.exceptAll(expected).count() == 0
    rn = windows.global_row_number(df, ["v", "id"], num_partitions=6)
    exp_rn = spark.sql("SELECT id, row_number() OVER (ORDER BY v, id) AS row_number FROM nt")
    assert rn.select("id", "row_number").exceptAll(exp_rn).count() == 0


@pytest.mark.parametrize("partitions", [3, 8, 50])
def test_row_number_with_a_payload_on_many_rows(spark, partitions):
    """Two million rows, ties, nulls and a column beside the sort key: every number once, in order."""
    df = spark.range(2_000_000).select(
        F.when(F.col("id") % 1000 > 0, F.pmod(F.xxhash64("id"), F.lit(5000)).cast("double")).alias("v"), "id", F.concat(F.lit("payload "), "id").alias("name"))
    rn = windows.global_row_number(df, ["v", "id"], num_partitions=partitions)
    checks = rn.agg(F.countDistinct("row_number"), F.min("row_number"), F.max("row_number"), F.countDistinct("name")).first()
    assert tuple(checks) == (2_000_000, 1, 2_000_000, 2_000_000)
    exact = df.selectExpr("id", "row_number() OVER (ORDER BY v, id) AS want")
    assert rn.join(exact, "id").filter("row_number <> want").count() == 0


def test_ntile_small_inputs(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0)], "id long, v double")
    got = sorted((r.id, r.tile) for r in windows.global_ntile(df, ["v", "id"], 4).collect())
    assert got == [(1, 1), (2, 2)]
    empty = spark.createDataFrame([], "id long, v double")
    assert windows.global_ntile(empty, ["v", "id"], 4).count() == 0


def test_top_k_equals_row_number(spark):
    rows = [(i, "hot" if i % 2 else f"g{i % 7}", float(i % 13)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    df.createOrReplaceTempView("tk")
    expected = spark.sql("""SELECT id, g, rank FROM (SELECT id, g, row_number() OVER (PARTITION BY g
                            ORDER BY v DESC, id) AS rank FROM tk) WHERE rank <= 3""")
    got = windows.top_k_per_group(df, ["g"], [F.desc("v"), F.asc("id")], 3)
    assert got.select("id", "g", F.col("rank").cast("int")).exceptAll(expected).count() == 0
    assert got.count() == expected.count()


def test_funnel_requires_order(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [
        (1, 1, t, "view"), (2, 1, t + dt.timedelta(minutes=1), "click"), (3, 1, t + dt.timedelta(minutes=2), "purchase"),
        (4, 2, t, "click"), (5, 2, t + dt.timedelta(minutes=1), "view"),  # click before view: step 2 not reached
        (6, 3, t, "view"), (7, 3, t, "click"),  # same instant counts as "not before"
        (8, 4, t, "purchase"),
    ]
    ev = spark.createDataFrame(rows, "event_id long, customer_id long, event_timestamp timestamp_ntz, "
                                     "event_type string")
    got = {r.step: r.users for r in usecases.funnel(lambda _: ev, ["view", "click", "purchase"]).collect()}
    assert got == {"view": 3, "click": 2, "purchase": 1}


def test_funnel_equals_sql_with_a_hot_user(spark, skewed_events):
    steps = ["view", "click", "purchase", "click", "view"] * 5
    skewed_events.createOrReplaceTempView("fe")
    ctes = ["r1 AS (SELECT customer_id, min(event_timestamp) AS at FROM fe WHERE event_type = 'view' GROUP BY 1)"]
    for i, step in enumerate(steps[1:], start=2):
        ctes.append(f"r{i} AS (SELECT e.customer_id, min(event_timestamp) AS at FROM fe e JOIN r{i - 1} p ON e.customer_id = p.customer_id "
                    f"WHERE event_type = '{step}' AND event_timestamp >= at GROUP BY 1)")
    want = [r[0] for i in range(1, len(steps) + 1) for r in spark.sql("WITH " + ", ".join(ctes[:i]) + f" SELECT count(*) FROM r{i}").collect()]
    got = usecases.funnel(lambda _: skewed_events, steps).orderBy("step_no").collect()
    assert [r.users for r in got] == want and want[0] == 30 and want[-1] < want[0]


def test_funnel_reads_events_once_and_splits_users(spark, tmp_root, skewed_events):
    skewed_events.write.parquet(f"{tmp_root}/ev")
    out = usecases.funnel(lambda _: spark.read.parquet(f"{tmp_root}/ev"), ["view", "click", "purchase"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan") == 1 and "Join" not in plan
    scan = plan[:plan.index("FileScan")]
    assert "hashpartitioning(_user" in scan and scan[scan.rindex("hashpartitioning("):].split(")")[0].count("#") == 2  # by user and time


def test_sessions_use_case_on_boundary(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 1, t), (2, 1, t + dt.timedelta(minutes=30)), (3, 1, t + dt.timedelta(minutes=60, seconds=1))]
    ev = spark.createDataFrame(rows, "event_id long, customer_id long, event_timestamp timestamp_ntz")
    got = sorted((r.session_no, r.events) for r in usecases.sessions(lambda _: ev).collect())
    assert got == [(1, 2), (2, 1)]  # exactly 30 minutes stays in the session


def test_reorder_alert_boundaries(spark):
    rows = [(1, 1, 1, "US", 50, 60, 10, 100, 2.5), (2, 1, 1, "US", 40, 10, 30, 100, 2.5),
            (3, 1, 1, "US", 40, 9, 30, 100, 2.5)]
    inv = spark.createDataFrame(rows, "inventory_id long, product_id long, supplier_id long, "
                                      "warehouse_location string, quantity_on_hand int, quantity_allocated int, "
                                      "reorder_point int, reorder_quantity int, unit_cost double") \
        .withColumn("unit_cost", F.col("unit_cost").cast("decimal(10,2)"))
    got = {r.inventory_id: r for r in usecases.reorder_alerts(lambda _: inv).collect()}
    assert set(got) == {1, 2}  # allocated > on hand, and available == reorder point
    assert got[1].available == -10 and str(got[2].reorder_cost) == "250.00"


def test_sessionize_keeps_rows_without_user_or_time(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 1, t), (2, None, t), (3, 1, None), (4, 1, t + dt.timedelta(hours=2))]
    ev = spark.createDataFrame(rows, "event_id long, customer_id long, event_timestamp timestamp_ntz")
    got = {r.event_id: r.session_no for r in
           windows.sessionize(ev, "customer_id", "event_timestamp", "event_id").collect()}
    assert got == {1: 1, 2: None, 3: None, 4: 2}


def test_sessionize_shares_one_events_exchange(spark, skewed_events):
    keys = skewed_events.select("customer_id", "event_timestamp", "event_id")
    out = windows.sessionize(keys, "customer_id", "event_timestamp", "event_id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in plan


def test_sessionize_ignores_session_time_zone(spark):
    """Wall-clock gaps across a daylight-saving change, under a DST session zone."""
    t = dt.datetime(2024, 3, 10, 1, 50)  # US clocks jump from 02:00 to 03:00 that night
    rows = [(1, 1, t), (2, 1, t + dt.timedelta(minutes=25)), (3, 1, t + dt.timedelta(minutes=50, seconds=1)),
            (4, 1, dt.datetime(2024, 11, 3, 1, 10)), (5, 1, dt.datetime(2024, 11, 3, 1, 40)),
            (6, 1, dt.datetime(2024, 11, 3, 1, 40, 0, 1))]
    ev = spark.createDataFrame(rows, "event_id long, customer_id long, event_timestamp timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = {r.event_id: r.session_no for r in
               windows.sessionize(ev, "customer_id", "event_timestamp", "event_id").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {1: 1, 2: 1, 3: 1, 4: 2, 5: 2, 6: 2}


def _reached(events, steps):
    """Steps reached by one user: events by time, those of one moment in the order of the steps."""
    done = 0
    for t in sorted({t for t, _ in events}):
        at_once = {s for x, s in events if x == t}
        while done < len(steps) and steps[done] in at_once:
            done += 1
    return done


def test_funnel_of_a_bot_is_linear(spark):
    """200,000 events of one user in one hour, beside others with ties and repeated steps; every bucket width agrees."""
    import random

    rng = random.Random(8)
    steps = ["a", "b", "a", "c", "c", "d"]
    start = dt.datetime(2024, 1, 1)
    users = {u: [(start + dt.timedelta(seconds=rng.randrange(0, 7200, 60)), rng.choice("abcde")) for _ in range(rng.randint(0, 30))] for u in range(60)}
    bot = [(start + dt.timedelta(microseconds=18_000 * i), "abdc"[(i // 50_000) % 4]) for i in range(200_000)]
    rows = [(u, t, s) for u, ev in users.items() for t, s in ev] + [(99, t, s) for t, s in bot] + [(None, start, "a"), (1, None, "a")]
    df = spark.createDataFrame(rows, "u long, t timestamp_ntz, s string").repartition(4)
    done = [_reached(ev, steps) for ev in users.values()] + [2]  # the bot's order is a b d c: no second a follows
    for seconds in (60, 300, 7200):
        got = {r.step_no: r.users for r in windows.ordered_funnel(df, "u", "t", "s", steps, bucket_seconds=seconds).collect()}
        assert got == {i + 1: sum(d > i for d in done) for i in range(len(steps))}


def test_funnel_has_a_bound(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "a")], "u long, t timestamp_ntz, s string")
    got = windows.ordered_funnel(df, "u", "t", "s", ["a"] * 62).collect()
    assert all(r.users == 1 for r in got) and len(got) == 62
    with pytest.raises(ValueError):
        windows.ordered_funnel(df, "u", "t", "s", ["a"] * 63)


def test_ranges_do_not_follow_the_shuffle_partitions(spark):
    df = spark.range(100_000).selectExpr("id % 97 AS v", "id")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400000")
    try:
        ranked = windows.global_row_number(df, ["v", "id"])
        plan = ranked._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(windows.range_bounds(df, ["v", "id"], windows.MAX_RANGES)) < windows.MAX_RANGES
    assert plan.count("AS k0") <= windows.MAX_RANGES + 1
    tiles = windows.global_ntile(df, ["v", "id"], 7)
    assert {r.tile: r["count"] for r in tiles.groupBy("tile").count().collect()} == {i: 100_000 // 7 + (i <= 100_000 % 7) for i in range(1, 8)}


def test_recent_orders_behind_dangling_ones(spark):
    """Ranges of ids are widened until k orders have a customer, and end with the table."""
    from ledgerline.plans import corpus

    day = dt.date(2024, 5, 1)
    customers = spark.createDataFrame([(c, f"name {c}") for c in range(50)], "customer_id long, customer_name string")

    def first(orders, k=10):
        tables = {"orders": spark.createDataFrame(orders, "order_id long, customer_id long, total_amount double, order_date date"), "customers": customers}
        got = [tuple(r) for r in corpus.recent_orders(lambda t: tables[t], k=k).collect()]
        want = sorted((o, a, f"name {c}") for o, c, a, d in orders if d >= dt.date(2024, 1, 1) and o is not None and c is not None and c < 50)
        assert got == want[:k]

    first([(i, 1000 + i if i < 700 else i % 50, 1.0 * i, day) for i in range(900)])
    first([(i, 1000 + i, 1.0, day) for i in range(250)] + [(250, 3, 2.0, day), (9, None, 1.0, day), (None, 3, 1.0, day)])
    first([(i // 300, i % 50, 1.0, day) for i in range(600)], k=3)  # ids that repeat
    first([(i, i % 50, 1.0, dt.date(2023, 1, 1)) for i in range(20)])
