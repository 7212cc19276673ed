from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session

    s = build_session("local[4]", app="ledgerline-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ledgerline-wh-")})
    # Tests run without a cluster: give the session its own checkpoint folder.
    if not s.conf.get("spark.checkpoint.dir", None):
        path = tempfile.mkdtemp(prefix="ledgerline-tests-")
        s.conf.set("spark.checkpoint.dir", path)
        s.sparkContext.setCheckpointDir(path)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="ledgerline-t-")


@pytest.fixture(scope="session")
def duck():
    import duckdb

    def connect(sf_dir: str):
        con = duckdb.connect()
        for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        return con

    return connect
