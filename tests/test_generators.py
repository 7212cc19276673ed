"""Generator properties: keys, domains, integrity, determinism, distributions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline import specs
from ledgerline.operators import quality
from ledgerline.operators.generate import generate, generate_all, plan_rows, plan_sizes

SIZES = {"customers": 300, "products": 200, "suppliers": 20, "orders": 1000, "lineitem": 4000,
         "inventory": 150, "events": 2000}


@pytest.mark.parametrize("profile", specs.PROFILES)
@pytest.mark.parametrize("table", specs.TABLE_ORDER)
def test_schema_keys_and_counts(spark, table, profile):
    df = generate(spark, table, SIZES[table], SIZES, profile=profile)
    declared = specs.spec(table).schema(profile)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in declared]
    key = specs.spec(table).key
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("d"),
                   F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    assert (stats.n, stats.d, stats.lo, stats.hi) == (SIZES[table], SIZES[table], 1, SIZES[table])


@pytest.mark.parametrize("profile", specs.PROFILES)
def test_no_orphans_by_construction(spark, profile):
    tables = generate_all(spark, SIZES, profile=profile)
    res = quality.orphans_all(lambda t: tables[t]).collect()
    assert len(res) == len(specs.RELATIONS)
    assert all(r.orphans == 0 for r in res), res
    events = next(r for r in res if r.child == "events" and r.column == "product_id")
    assert events.checked < SIZES["events"]  # nulls are skipped on the nullable key


def test_domains(spark):
    c = generate(spark, "customers", 2000, SIZES)
    assert {r.country for r in c.select("country").distinct().collect()} <= set(specs.COUNTRIES)
    assert {r.region for r in c.select("region").distinct().collect()} <= set(specs.REGIONS)
    o = generate(spark, "orders", 3000, SIZES)
    assert {r[0] for r in o.select("order_status").distinct().collect()} == set(specs.ORDER_STATUSES)
    li = generate(spark, "lineitem", 3000, SIZES)
    q = li.agg(F.min("quantity"), F.max("quantity")).first()
    assert (q[0], q[1]) == (1, 19)  # half-open 1..19
    e = generate(spark, "events", 3000, SIZES)
    ip = (e.select(F.explode(F.split("ip_address", r"\.")).alias("s"))
          .select(F.col("s").cast("int").alias("o")))
    lo, hi = ip.agg(F.min("o"), F.max("o")).first()
    assert 1 <= lo and hi <= 255
    assert e.filter(~F.col("session_id").rlike("^session_[0-9a-f]{8}$")).count() == 0


def test_dates_and_windows(spark):
    o = generate(spark, "orders", 5000, SIZES)
    b = o.agg(F.min("order_date"), F.max("order_date"),
              F.min(F.datediff("ship_date", "order_date")), F.max(F.datediff("ship_date", "order_date")),
              F.min(F.datediff("delivery_date", "order_date")), F.max(F.datediff("delivery_date", "order_date"))
              ).first()
    assert b[0] == dt.date(2022, 1, 1) and b[1] == dt.date(2024, 1, 1)
    assert (b[2], b[3]) == (1, 3) and (b[4], b[5]) == (3, 10)
    # Hourly series wrap inside their window instead of running for decades.
    c = generate(spark, "customers", 40000, SIZES)
    lo, hi = c.agg(F.min("registration_date"), F.max("registration_date")).first()
    assert lo == dt.date(2020, 1, 1) and hi < dt.date(2024, 1, 1)
    e = generate(spark, "events", 5000, SIZES, profile="base")
    last = e.agg(F.max("event_timestamp")).first()[0]
    assert last == dt.datetime(2024, 1, 1) + dt.timedelta(seconds=4999)


def test_suppliers_year_matches_date(spark):
    s = generate(spark, "suppliers", 500, SIZES)
    assert s.filter(F.year("established_date") != F.col("established_year")).count() == 0
    lo, hi = s.agg(F.min("established_date"), F.max("established_date")).first()
    assert lo == dt.date(2000, 1, 1) and hi == dt.date(2020, 1, 1)


def test_lake_money_relations(spark):
    li = generate(spark, "lineitem", 5000, SIZES)
    bad = li.filter(F.col("extended_price") != (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)"))
    assert bad.count() == 0
    # discount/tax amounts use their own draws (published semantics), bounded by the ranges.
    ratio = li.filter(F.col("extended_price") >= 10).select(  # cent rounding is < 0.1% here
        (F.col("discount_amount") / F.col("extended_price")).alias("d"),
        (F.col("net_amount") / F.col("extended_price")).alias("n"))
    d_hi, n_lo, n_hi = ratio.agg(F.max("d"), F.min("n"), F.max("n")).first()
    assert d_hi <= 0.31 and n_lo >= 0.79 and n_hi <= 1.21


def test_same_rows_for_any_partitioning(spark):
    """Values depend on (seed, table, column, id) only."""
    digests = set()
    for per_part in (10_000, 2_500, 625):  # 1, 4 and 16 partitions
        df = generate(spark, "events", 10_000, SIZES, rows_per_partition=per_part)
        assert df.rdd.getNumPartitions() >= 1
        digests.add(df.select(F.bit_xor(F.xxhash64(*df.columns)).alias("h")).first().h)
    assert len(digests) == 1
    other = generate(spark, "events", 10_000, SIZES, seed=7).select(F.bit_xor(F.xxhash64("event_id", "event_type"))).first()[0]
    same = generate(spark, "events", 10_000, SIZES).select(F.bit_xor(F.xxhash64("event_id", "event_type"))).first()[0]
    assert other != same


def test_distributions(spark):
    n = 100_000
    c = generate(spark, "customers", n, SIZES)
    s = c.agg(F.avg(F.col("is_premium").cast("int")).alias("p"), F.avg("lifetime_value").alias("ltv"),
              F.avg("credit_score").alias("score")).first()
    assert abs(s.p - 0.2) < 0.01
    assert abs(s.ltv - 500) / 500 < 0.02
    assert abs(s.score - 650) < 2
    e = generate(spark, "events", n, SIZES)
    share = e.agg(F.avg(F.col("search_query").isNotNull().cast("int"))).first()[0]
    assert 0.28 <= share <= 0.32
    nulls = e.agg(F.avg(F.col("product_id").isNull().cast("int"))).first()[0]
    assert abs(nulls - 1 / (SIZES["products"] + 1)) < 0.002


def test_xxhash_draws_are_valid_too(spark):
    df = generate(spark, "orders", 2000, SIZES, hash="xxhash64")
    assert df.filter(F.col("customer_id").between(1, SIZES["customers"])).count() == 2000
    with pytest.raises(ValueError):
        generate(spark, "orders", 10, SIZES, hash="sha1")


def test_base_emails_use_row_id(spark):
    """Base emails and descriptions come from the row id, so they never repeat."""
    c = generate(spark, "customers", 3000, SIZES, profile="base")
    assert c.select("email").distinct().count() == 3000
    p = generate(spark, "products", 200, SIZES, profile="base")
    assert p.select("description").distinct().count() == 200


def test_plan_rows_ratios():
    plan = {p["table"]: p for p in plan_rows(1000)}
    assert plan["lineitem"]["rows"] == 600_000_000
    assert plan["events"]["rows"] == 200_000_000
    assert plan["orders"]["rows"] == 80_000_000
    assert plan["customers"]["target_rows"] == 50_000_000 and plan["customers"]["rows"] == 50_000_000
    assert plan["products"]["rows"] == 30_000_000
    assert plan["suppliers"]["rows"] == 20_000_000
    assert plan["inventory"]["rows"] == 20_000_000
    assert abs(sum(specs.SIZE_RATIOS.values()) - 1.0) < 1e-9
    assert plan_sizes(10)["suppliers"] == 200_000 and plan_sizes(10)["lineitem"] == 6_000_000
    assert plan_sizes(0.000001)["customers"] == 1  # never zero rows
    with pytest.raises(ValueError):
        plan_rows(10, ["customers", "nope"])


def test_unknown_inputs_raise(spark):
    with pytest.raises(ValueError):
        generate(spark, "nope", 10, SIZES)
    with pytest.raises(ValueError):
        generate(spark, "orders", 10, SIZES, profile="other")
    with pytest.raises(ValueError):
        generate(spark, "orders", 10, {"products": 5})  # parent size missing


def test_base_supplier_dates_stay_in_window(spark):
    """D3: 100,000 daily steps from 2000-01-01 wrap inside 2000..2020 instead of overflowing."""
    s = generate(spark, "suppliers", 100_000, SIZES, profile="base")
    lo, hi, n = s.agg(F.min("established_date"), F.max("established_date"), F.count(F.lit(1))).first()
    assert n == 100_000
    assert lo == dt.datetime(2000, 1, 1) and hi < dt.datetime(2020, 1, 1)


def test_plan_rows_partitions(spark):
    from ledgerline.operators.generate import plan_rows_df

    plan = {r.table: r for r in plan_rows_df(spark, 1000, profile="base").collect()}
    assert plan["lineitem"].partitions == 600 and plan["suppliers"].partitions == 20
    lake = {p["table"]: p for p in plan_rows(100)}
    assert lake["lineitem"]["partitions"] == 120  # 60M rows in 500K-row chunks


def test_even_dates_of_any_size(spark):
    from ledgerline.functions.draws import even_date

    start, span = dt.date(2022, 1, 1), 730 * 86400
    for n in (1, 2, 1000, 60_000_000_000, 200_000_000_000, 10**12):
        ids = sorted({1, 2, n // 3 + 1, n // 2 + 1, n - 1 or 1, n})
        got = spark.createDataFrame([(i,) for i in ids], "id long").select("id", even_date("id", n, "2022-01-01", "2024-01-01").alias("d")).collect()
        assert {r.id: r.d for r in got} == {i: start + dt.timedelta(days=(i - 1) * span // max(n - 1, 1) // 86400) for i in ids}


def test_rows_asked_for_are_made_and_keys_resolve(spark):
    """No row caps: 30M customers are planned as 30M, and orders point at any of them."""
    sizes = {"customers": 30_000_000, "orders": 2000}
    assert generate(spark, "customers", sizes["customers"], sizes).count() == 30_000_000
    plan = {p["table"]: p["rows"] for p in plan_rows(10_000)}
    assert plan["customers"] == 500_000_000 and plan["products"] == 300_000_000 and plan["suppliers"] == 200_000_000
    lo, hi = generate(spark, "orders", 2000, sizes).agg(F.min("customer_id"), F.max("customer_id")).first()
    assert 1 <= lo and 25_000_000 < hi <= 30_000_000


def _plain(v):
    return v.replace(tzinfo=None) if isinstance(v, dt.datetime) else str(v.normalize() if v else 0) if v.__class__.__name__ == "Decimal" else v


@pytest.mark.parametrize("profile", specs.PROFILES)
@pytest.mark.parametrize("table", specs.TABLE_ORDER)
def test_rows_equal_independent_sql(spark, duck, table, profile):
    """Every generated value equals that of SQL written apart from the recipes, row for row, at the given tables' sizes."""
    from conftest import SF_SMALL
    from ledgerline.oracle.generators_sql import SIZE_SOURCES, generator_sql

    con = duck(SF_SMALL)
    sizes = {t: max(1, con.execute(f"SELECT count(*) FROM {source}").fetchone()[0]) for t, source in SIZE_SOURCES.items()}
    df = generate(spark, table, sizes[table], sizes, profile=profile)
    found = con.execute(generator_sql(table, profile))
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    want = {r[names.index(specs.spec(table).key)]: [_plain(v) for v in r] for r in found.fetchall()}
    got = {r[specs.spec(table).key]: [_plain(r[n]) for n in names] for r in df.collect()}
    wrong = [(k, n, g, w) for k in want for n, g, w in zip(names, got[k], want[k], strict=True) if g != w]
    assert got.keys() == want.keys() and not wrong, wrong[:5]


def test_reorder_alerts_equal_sql(spark, duck):
    from conftest import SF_SMALL
    from ledgerline.oracle.extra_sql import REORDER_ALERTS_SQL
    from ledgerline.oracle.generators_sql import SIZE_SOURCES
    from ledgerline.plans import usecases

    con = duck(SF_SMALL)
    sizes = {t: max(1, con.execute(f"SELECT count(*) FROM {source}").fetchone()[0]) for t, source in SIZE_SOURCES.items()}
    inventory = generate(spark, "inventory", sizes["inventory"], sizes)
    alerts = usecases.reorder_alerts(lambda t: {"inventory": inventory}[t])
    found = con.execute(REORDER_ALERTS_SQL)
    names = [d[0] for d in found.description]
    assert sorted(tuple(map(str, (r[n] for n in names))) for r in alerts.collect()) == sorted(tuple(map(str, r)) for r in found.fetchall())
