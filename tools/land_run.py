"""Land a whole size plan to disk, then run plans over the landed lake.

    python tools/land_run.py ROOT [size_gb]     # default 10 GB plan (9.9M rows)

ROOT must be a new, empty folder.  Prints the run report (rows, files,
layout, seconds per table), the landed size, and the time of a few plans
over the Parquet lake (reads with pruning).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.operators import quality  # noqa: E402
from ledgerline.plans import corpus, usecases  # noqa: E402
from ledgerline.session import build_session  # noqa: E402
from ledgerline.sinks import layout  # noqa: E402
from ledgerline.sinks.land import land  # noqa: E402


def main() -> None:
    root = sys.argv[1]
    gb = float(sys.argv[2]) if len(sys.argv) > 2 else 10.0
    spark = build_session("local[8]", shuffle_partitions=16, extra={"spark.driver.memory": "16g"})
    t0 = time.perf_counter()
    rows = land(spark, root, size_gb=gb, profile="lake", parallel=4).collect()
    dt = time.perf_counter() - t0
    for r in rows:
        print(f"LAND {r.table:10s} rows={r.actual_rows:>12,} files={r.files:>5} layout={r.granularity} "
              f"{r.seconds:7.1f}s ok={r.ok}")
    total = sum(r.actual_rows for r in rows)
    print(f"LAND total {total:,} rows in {dt:.1f}s = {total / dt:,.0f} rows/s")
    tables = lambda t: layout.read_table(spark, os.path.join(root, t))
    plans = {
        "K2 top_products": corpus.top_products(tables),
        "K5 sales_by_country (last month)": corpus.sales_by_country(tables, "2023-12-01"),
        "K7 revenue_by_category (last month)": corpus.revenue_by_category(tables, "2023-12-01"),
        "Q3 orphans_all": quality.orphans_all(tables),
        "C5 top3_per_category": usecases.top3_per_category(tables),
        "C7 sessions": usecases.sessions(tables),
    }
    for name, df in plans.items():
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        print(f"READ {name}: {time.perf_counter() - t0:.2f}s")
    spark.stop()


if __name__ == "__main__":
    main()
