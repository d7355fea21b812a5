"""Row counts and measure sums of FIXTURES.md section 4 (measured once in
DuckDB with the reference's literal semantics)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.config import FIXTURE_CONFIG as CFG
from daybook.plans import catalog
from daybook.sources.fixtures import fixture_sources

# metric -> measure -> {sf: (rows, sum)}
EXPECTED = {
    "nru_day": ("nru1", {"0.001": (15, 13), "0.01": (128, 128)}),
    "dau_day": ("dau", {"0.001": (388, 165), "0.01": (2607, 1535)}),
    "pu_day": ("pu", {"0.001": (370, 153), "0.01": (2338, 1438)}),
    "eru_day": ("eru", {"0.001": (6, 6), "0.01": (44, 46)}),
    "rau_day": ("rau", {"0.001": (6, 6), "0.01": (52, 52)}),
    "sales_day": ("real_cash_kr", {"0.001": (202, Decimal("10424.69")), "0.01": (1976, Decimal("95455.77"))}),
    "ru_day": ("date_count", {"0.001": (380, 14), "0.01": (1628, 135)}),
    "retention_day": ("user_count", {"0.001": (15, 15), "0.01": (128, 143)}),
    "nru_week": ("nru1", {"0.001": (14, 13), "0.01": (97, 135)}),
    "wau_week": ("wau", {"0.001": (74, 78), "0.01": (406, 766)}),
    "pu_week": ("pu", {"0.001": (55, 59), "0.01": (341, 566)}),
    "eru_week": ("eru", {"0.001": (6, 6), "0.01": (44, 60)}),
    "rau_week": ("rau", {"0.001": (5, 5), "0.01": (43, 44)}),
    "sales_week": ("real_cash_kr", {"0.001": (184, Decimal("9337.04")), "0.01": (1736, Decimal("86395.81"))}),
}
SECOND = {
    "dau_day": ("sum_month_dau", {"0.001": 413, "0.01": 4267}),
    "pu_day": ("sum_month_pu", {"0.001": 398, "0.01": 3853}),
    "ru_day": ("sum_date_count", {"0.001": 41, "0.01": 1220}),
}


@pytest.fixture(scope="module")
def sources(spark):
    return {sf: fixture_sources(spark, f"/root/testdata/sf{sf}") for sf in ("0.001", "0.01")}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_rows_and_sums(sources, sf, name):
    measure, by_sf = EXPECTED[name]
    df = catalog.metric(name, CFG, sources[sf])
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(measure).alias("s")]
    if name in SECOND:
        aggs.append(F.sum(SECOND[name][0]).alias("s2"))
    r = df.agg(*aggs).collect()[0]
    assert (r["n"], r["s"]) == by_sf[sf]
    if name in SECOND:
        assert r["s2"] == SECOND[name][1][sf]


@pytest.mark.parametrize("sf,expected", [("0.001", 1), ("0.01", 33)])
def test_sales_week_user_count(sources, sf, expected):
    parity = catalog.metric("sales_week", CFG, sources[sf])
    assert parity.filter("user_count != 1").count() == 0
    members = catalog.metric("sales_week_members", CFG, sources[sf])
    assert members.filter("user_count > 1").count() == expected
