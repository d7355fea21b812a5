"""Every registered query against its independent DuckDB statement.

All queries run at sf0.001; the driver's scale (sf0.01) is covered for the
metrics whose month-to-date, seed and merge logic has the most room to go
wrong.
"""

import pytest

import __spark_entry__ as se
from conftest import duck_for
from daybook.plans import catalog
from helpers import rows

NAMES = sorted(catalog.queries())
SF01 = ["dau_day", "pu_day", "ru_day", "retention_day", "rau_day", "dau_day_incremental", "ru_day_incremental", "ru_day_seeded", "replace_range", "pu_week"]


def _compare(spark, sf_dir, name):
    sp = se.queries()[name](spark, sf_dir).toPandas()
    dk = duck_for(sf_dir).execute(se.oracle_sql()[name]).df()
    sc, sr = rows(sp)
    dc, dr = rows(dk)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_every_query_has_an_oracle():
    assert set(NAMES) == set(catalog.oracle_statements()) and set(NAMES) <= set(se.queries())


@pytest.mark.parametrize("name", NAMES)
def test_sf0001(spark, sf001_dir, name):
    _compare(spark, sf001_dir, name)


@pytest.mark.parametrize("name", SF01)
def test_sf001(spark, sf01_dir, name):
    _compare(spark, sf01_dir, name)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["game_code", "division_date", "os_type", "country_code", "dau", "sum_month_dau"]
    assert df.count() > 0


# Other parameters: negative local offset, three days of overlap, a report time
# with a time of day, a weekly bookmark on a Saturday.


def _variant():
    from datetime import date, datetime

    from daybook.plans.catalog import CFG

    return CFG.replace(
        tz_offset_hours=-5,
        before_days=3,
        start=date(2024, 1, 12),
        week_start=date(2024, 1, 6),
        as_of=datetime(2024, 1, 27, 13, 30),
    )


@pytest.mark.parametrize("name", __import__("daybook.plans.catalog", fromlist=["METRICS"]).METRICS)
def test_other_parameters(spark, sf01_dir, name):
    from daybook import oracle
    from daybook.plans import catalog
    from daybook.sources.fixtures import fixture_sources

    cfg = _variant()
    df = catalog.present(catalog.metric(name, cfg, fixture_sources(spark, sf01_dir, cfg.tz_offset_hours)))
    sp = df.toPandas()
    dk = duck_for(sf01_dir).execute(oracle.statement(name, cfg)).df()
    assert rows(sp) == rows(dk)
    assert len(sp) > 0


def test_months_cover_every_order(spark, sf001_dir):
    """Each finished order is in a reported day and a reported week."""
    orders = spark.read.parquet(f"{sf001_dir}/orders.parquet")
    q = se.queries()
    for name in ("sales_day_months", "sales_week_months"):
        assert q[name](spark, sf001_dir).agg({"sales_count": "sum"}).first()[0] == orders.filter("o_orderstatus = 'F'").count()
