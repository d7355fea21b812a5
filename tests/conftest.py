import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from daybook.session import local_session  # noqa: E402

TESTDATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=4, app="daybook-tests")
    yield s
    s.stop()


def duck_for(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.fixture(scope="session")
def sf001_dir():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def sf01_dir():
    return f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="session")
def full_store_sf0001(spark):
    """One full daily + weekly runner pass on sf0.001 (read-only for tests)."""
    import tempfile

    from daybook.config import FIXTURE_CONFIG
    from daybook.plans import runner
    from daybook.sources.fixtures import fixture_sources
    from daybook.sources.sinks import TableStore

    src = fixture_sources(spark, f"{TESTDATA}/sf0.001")
    store = TableStore(spark, tempfile.mkdtemp(prefix="daybook-full-"))
    runner.run_daily(spark, store, src, FIXTURE_CONFIG)
    runner.run_weekly(spark, store, src, FIXTURE_CONFIG)
    return store
