"""A hot member holding a third of all events: results stay exact.

The skewed table is derived from the given sf0.01 events by moving every
third event to member 1 (including a third of all sign-ups, clicks and
purchases), so one member dominates every log. Every registered query is
compared with its oracle on that data.
"""

import os
import tempfile

import duckdb
import pytest

import __spark_entry__ as se
from conftest import duck_for
from helpers import rows

NAMES = ["dau_day", "pu_day", "rau_day", "retention_day", "sales_day", "wau_week", "pu_week", "eru_week", "eru_day", "ru_day_incremental"]


@pytest.fixture(scope="module")
def skewed_dir():
    out = tempfile.mkdtemp(prefix="daybook-skew-")
    src = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(
        f"""COPY (SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN CAST(1 AS BIGINT) ELSE user_id END AS user_id,
                         event_type, value, props
                    FROM read_parquet('{src}/events.parquet'))
             TO '{out}/events.parquet' (FORMAT PARQUET)"""
    )
    con.execute(f"COPY (SELECT * FROM read_parquet('{src}/customer.parquet')) TO '{out}/customer.parquet' (FORMAT PARQUET)")
    n_hot, n = con.execute(f"SELECT count(*) FILTER (WHERE user_id = 1), count(*) FROM read_parquet('{out}/events.parquet')").fetchone()
    assert n_hot * 3 >= n
    return out


@pytest.mark.parametrize("name", NAMES)
def test_hot_member(spark, skewed_dir, name):
    sp = se.queries()[name](spark, skewed_dir).toPandas()
    dk = duck_for(skewed_dir).execute(se.oracle_sql()[name]).df()
    assert rows(sp) == rows(dk)
    assert len(sp) > 0
