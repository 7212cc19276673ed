"""Generate and land a whole data set: the run loop (R5), report (W10), manifest.

One Spark job per table; each job commits atomically, so a table is
either fully written or not visible as written.  The report compares the
planned rows with the rows the landed files' footers state, so a task that ran
twice counts once.
"""

from __future__ import annotations

import os
import threading
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ledgerline import specs
from ledgerline.operators.generate import DEFAULT_SEED, generate, plan_rows
from ledgerline.sinks import layout

REPORT_SCHEMA = ("table string, planned_rows bigint, written_rows bigint, actual_rows bigint, files bigint, "
                 "granularity string, seconds double, ok boolean, error string")


def land(spark: SparkSession, root: str, size_gb: float | None = None, sizes: dict[str, int] | None = None,
         tables: list[str] | None = None, profile: str = "lake", layout_kind: str | None = None,
         granularity: str = "day", on_error: str = "stop", seed: int = DEFAULT_SEED, hash: str = "md5",
         manifest: bool = True, buckets: dict[str, tuple[str, int]] | None = None,
         namespace: str | None = None, parallel: int = 1) -> DataFrame:
    """Generate the chosen tables and write them under ``root/<table>``.

    Sizes come from ``size_gb`` (ratios and rows per GB) or directly from
    ``sizes``.  The lake profile's folders are those of the published spec
    unless ``granularity`` asks for coarser ones.  Unknown table names raise before any work.  With
    ``on_error="stop"`` the first failing table ends the run; with
    ``"continue"`` the others are still written.  The base profile lands
    flat folders, the lake profile partitioned ones (override with
    ``layout_kind``).  ``buckets`` (``{"lineitem": ("order_id", 512),
    "orders": ("order_id", 512)}``) writes those tables as bucketed catalog
    tables ``namespace.<table>`` (W6), so joins on the bucket key need no
    shuffle.  ``parallel`` > 1 runs that many table jobs at once (Spark
    schedules their tasks side by side), so small tables do not leave the
    cluster idle; with ``on_error="stop"`` tables not yet started when a
    job fails are skipped.  Returns the run report (generation order).
    """
    buckets = dict(buckets or {})
    if buckets and not namespace:
        raise ValueError("bucketed tables are catalog tables: give a namespace")
    specs.check_profile(profile)
    if on_error not in ("stop", "continue"):
        raise ValueError("on_error must be 'stop' or 'continue'")
    if (size_gb is None) == (sizes is None):
        raise ValueError("give exactly one of size_gb or sizes")
    names = list(tables) if tables else list(specs.TABLE_ORDER)
    for t in names:
        specs.spec(t)
    planned = ({p["table"]: p["rows"] for p in plan_rows(size_gb)} if size_gb is not None
               else dict(sizes))
    kind = layout_kind or ("partitioned" if profile == "lake" else "flat")
    todo = [t for t in specs.TABLE_ORDER if t in names]
    stop = threading.Event()

    def one(t: str):
        if stop.is_set():
            return None
        t0 = time.perf_counter()
        path = os.path.join(root, t)
        try:
            df = generate(spark, t, planned[t], planned, profile=profile, seed=seed, hash=hash)
            if t in buckets:
                rep = _write_bucketed(spark, df, path, t, profile, namespace, *buckets[t])
            else:
                rep = layout.write_table(df, path, t, profile, layout=kind, granularity=granularity)
            return rep, report_row(t, planned[t], rep, time.perf_counter() - t0)
        except Exception as e:  # noqa: BLE001 - recorded in the report
            if on_error == "stop":
                stop.set()
            return None, (t, planned[t], 0, 0, 0, None, round(time.perf_counter() - t0, 3), False,
                          f"{type(e).__name__}: {str(e)[:500]}")

    if parallel > 1:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            results = list(pool.map(one, todo))
    else:
        results = []
        for t in todo:
            results.append(one(t))
            if stop.is_set():
                break
    report = [r[1] for r in results if r is not None]
    written = [r[0] for r in results if r is not None and r[0] is not None]
    if manifest:
        m = layout.manifest_row(root, size_gb if size_gb is not None else 0.0, profile, written)
        layout.write_manifest(spark, root, m)
    return spark.createDataFrame(report, REPORT_SCHEMA)


def report_row(table: str, planned: int, rep: dict, seconds: float) -> tuple:
    """One row of :data:`REPORT_SCHEMA`. ``ok`` when the rows planned, those the writing job counted and
    those the landed files state are the same; otherwise the error says which differ."""
    written, rows = rep["written"], rep["rows"]
    ok = planned == written == rows
    error = None if ok else f"planned {planned}, written {written}, landed {rows} rows"
    return (table, planned, written, rows, rep["files"], rep["granularity"], round(seconds, 3), ok, error)


def land_tables(spark: SparkSession, root: str, tables: dict[str, DataFrame], planned: dict[str, int] | None = None,
                profile: str = "lake", granularity: str = "day", fill: bool = False) -> DataFrame:
    """Land given frames under ``root/<table>`` by the tables' specs; the run report.

    ``planned`` are the rows to expect (by default each frame's own count).
    ``fill`` lets declared columns that a frame lacks be null."""
    unknown = set(tables) - set(specs.TABLE_ORDER)
    if unknown:
        raise ValueError(f"unknown tables {sorted(unknown)}; expected some of {specs.TABLE_ORDER}")
    report = []
    for t in [t for t in specs.TABLE_ORDER if t in tables]:
        t0 = time.perf_counter()
        df = tables[t]
        absent = tuple(set(specs.spec(t).schema(profile).fieldNames()) - set(df.columns)) if fill else ()
        expected = df.count() if planned is None else planned[t]
        rep = layout.write_table(df, os.path.join(root, t), t, profile, granularity=granularity, fill=absent)
        report.append(report_row(t, expected, rep, time.perf_counter() - t0))
    return spark.createDataFrame(report, REPORT_SCHEMA)


def _write_bucketed(spark: SparkSession, df: DataFrame, path: str, table: str, profile: str, namespace: str,
                    key: str, n: int) -> dict:
    from ledgerline.sources.catalog import create_namespace

    create_namespace(spark, namespace)
    data = layout.conform(df, specs.spec(table).schema(profile))
    written = layout.write_bucketed(data, f"{namespace}.{table}", key, n, path)
    rows, files = layout.landed(spark, path)
    return {"table": table, "path": path, "rows": rows, "files": files, "written": written, "partition_cols": [],
            "granularity": f"bucket({n}, {key})"}
