"""Run the corpus, quality checks and use cases over generated tables of a size plan.

    python tools/scale_run.py [size_gb]      # default 10 (6M line items, 2M events, ...)

Tables are generated on the fly (xxhash64 draws, nothing written); each
plan runs to completion through the noop sink.  Prints the time and the
join strategies of each plan.
"""
import sys, time
sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__))))
from ledgerline.session import build_session
from ledgerline.operators.generate import generate, plan_sizes
from ledgerline.plans import corpus, usecases
from ledgerline.operators import quality
spark = build_session("local[8]", shuffle_partitions=16, extra={"spark.driver.memory": "16g"})
gb = float(sys.argv[1]) if len(sys.argv) > 1 else 10
sizes = plan_sizes(gb)
print("SIZES", sizes)
tables = lambda t: generate(spark, t, sizes[t], sizes, hash="xxhash64")
plans = {
    "K1": lambda: corpus.ltv_by_country_region(tables),
    "K2": lambda: corpus.top_products(tables),
    "K5": lambda: corpus.sales_by_country(tables, "2023-01-01"),
    "K7": lambda: corpus.revenue_by_category(tables, "2023-06-01"),
    "K9": lambda: corpus.orders_without_customer(tables),
    "Q3": lambda: quality.orphans_all(tables),
    "C1": lambda: usecases.segments(tables),
    "C3": lambda: usecases.supplier_scorecard(tables),
    "C5": lambda: usecases.top3_per_category(tables),
    "C7": lambda: usecases.sessions(tables),
    "C8": lambda: usecases.funnel(tables, ["page_view", "add_to_cart", "purchase"]),
}
for name, mk in plans.items():
    df = mk()
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    dt = time.perf_counter() - t0
    plan = df._jdf.queryExecution().executedPlan().toString()
    print(f"SCALE {name} {dt:7.2f}s  smj={plan.count('SortMergeJoin')} bhj={plan.count('BroadcastHashJoin')}")
