import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskloom.session import build_session

    session = build_session(
        master="local[*]", app_name="riskloom-tests", shuffle_partitions=8, driver_memory="8g",
        extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="riskloom-test-ckpt-")})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="riskloom-test-")
