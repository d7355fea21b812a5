"""Hand-built scenario: NULL-segment policies, joins and quirks of each metric.

Expected values are worked out by hand from the reference semantics.

Config: local offset 9 h, one day overlap, daily bookmark 2024-01-03 (report
days 01-03..01-09), weekly bookmark 2023-12-24 (report week 2023-12-31).
"""

from datetime import date, datetime
from decimal import Decimal

import pytest

from daybook.config import KpiConfig
from daybook.plans import daily, weekly
from helpers import d, make_sources, spark_rows, ts

CFG = KpiConfig(
    game_code="g",
    tz_offset_hours=9,
    before_days=1,
    start=date(2024, 1, 3),
    week_start=date(2023, 12, 24),
    as_of=datetime(2024, 1, 10),
)

MEMBERS = [
    (1, ts("2024-01-02 20:00:00"), "a"),  # local 01-03 05:00
    (2, ts("2024-01-03 01:00:00"), ""),  # local 01-03, NULL profile os
    (3, ts("2024-01-03 02:00:00"), "c"),  # local 01-03, no profile
    (4, ts("2023-12-01 00:00:00"), "d"),  # old member
    (5, ts("2024-01-04 00:00:00"), None),  # local 01-04, NULL name
    (6, ts("2024-01-02 10:00:00"), "f"),  # local 01-02 = day_lo (outside daily report)
    (7, ts("2023-11-01 00:00:00"), "g"),  # old member, no profile
]
PROFILE = [(1, 1, "01"), (2, None, "02"), (4, 1, "01"), (5, 2, "03"), (6, 1, "01")]
LOGIN = [
    (1, ts("2024-01-03 08:00:00"), 5, "05", 1),
    (1, ts("2024-01-03 09:00:00"), 5, "05", 2),
    (2, ts("2024-01-04 08:00:00"), 7, "09", 1),
    (3, ts("2024-01-04 09:00:00"), 5, "05", 1),
    (4, ts("2024-01-05 08:00:00"), 3, "03", 1),
    (1, ts("2024-01-05 08:00:00"), 5, "05", 1),
    (2, ts("2024-01-06 08:00:00"), None, None, 1),
    (4, ts("2023-12-28 08:00:00"), 3, "03", 1),
    (7, ts("2024-01-07 10:00:00"), 2, "02", 1),
]
BILLING = [
    (1, ts("2024-01-03 12:00:00"), 5, "05", 0, 10, Decimal("10.00")),
    (1, ts("2024-01-03 13:00:00"), 5, "05", 0, 10, Decimal("5.50")),
    (2, ts("2024-01-04 12:00:00"), 7, "09", 1, 11, Decimal("3.00")),
    (1, ts("2024-01-08 12:00:00"), 6, "06", 0, 10, Decimal("1.25")),
    (1, ts("2024-01-05 12:00:00"), 4, "05", 0, 12, Decimal("2.00")),
]
TUTORIAL = [
    (2, ts("2024-01-03 12:00:00"), 7, "09"),
    (2, ts("2024-01-03 13:00:00"), 7, "09"),
    (1, ts("2024-01-04 12:00:00"), 5, "05"),
    (3, ts("2024-01-03 12:00:00"), 5, "05"),
]


@pytest.fixture(scope="module")
def src(spark):
    return make_sources(spark, MEMBERS, PROFILE, LOGIN, BILLING, TUTORIAL)


def test_nru_day_inner_profile_defaults_and_null_name(src):
    got = spark_rows(daily.nru_day(CFG, src), ["division_date", "os_type", "country_code", "nru1", "nru2"])
    assert got == sorted(
        [(d("2024-01-03"), 1, "01", 1, 0), (d("2024-01-03"), 0, "02", 0, 1), (d("2024-01-04"), 2, "03", 0, 0)],
        key=lambda r: tuple((x is None, str(x)) for x in r),
    )


def test_nru_week_left_profile(src):
    got = spark_rows(weekly.nru_week(CFG, src), ["division_week", "os_type", "country_code", "nru1", "nru2"])
    w = d("2023-12-31")
    assert set(got) == {(w, 1, "01", 2, 0), (w, 0, "02", 0, 1), (w, 0, "00", 1, 0), (w, 2, "03", 0, 0)}


def test_dau_day_coalesce_segment_and_mtd(src):
    got = set(spark_rows(daily.dau_day(CFG, src), ["division_date", "os_type", "country_code", "dau", "sum_month_dau"]))
    exp = {
        (d("2024-01-03"), 1, "01", 1, 1),
        (d("2024-01-04"), 1, "01", 0, 1),
        (d("2024-01-05"), 1, "01", 2, 2),
        (d("2024-01-06"), 1, "01", 0, 2),
        (d("2024-01-07"), 1, "01", 0, 2),
        (d("2024-01-04"), 7, "02", 1, 1),
        (d("2024-01-05"), 7, "02", 0, 1),
        (d("2024-01-06"), 7, "02", 0, 1),
        (d("2024-01-07"), 7, "02", 0, 1),
    }
    assert got == exp


def test_pu_day_profile_segment_null_vanishes(src):
    got = set(spark_rows(daily.pu_day(CFG, src), ["division_date", "os_type", "country_code", "pu", "sum_month_pu"]))
    exp = {
        (d("2024-01-03"), 1, "01", 1, 1),
        (d("2024-01-04"), 1, "01", 0, 1),
        (d("2024-01-05"), 1, "01", 1, 1),
        (d("2024-01-08"), 1, "01", 1, 1),
    }
    assert got == exp


def test_eru_day_members_on_reg_day_null_segment_is_a_group(src):
    got = spark_rows(daily.eru_day(CFG, src), ["division_date", "os_type", "country_code", "eru"])
    assert got == [(d("2024-01-03"), None, "02", 1)]


def test_eru_week_counts_rows_with_log_segment(src):
    got = set(spark_rows(weekly.eru_week(CFG, src), ["division_week", "os_type", "country_code", "eru"]))
    assert got == {(d("2023-12-31"), 7, "09", 2), (d("2023-12-31"), 5, "05", 1)}


def test_rau_day_gap_registration_and_left_profile(src):
    got = set(spark_rows(daily.rau_day(CFG, src), ["division_date", "os_type", "country_code", "rau"]))
    assert got == {(d("2024-01-05"), 1, "01", 1), (d("2024-01-07"), 0, "00", 1)}


def test_wau_week_log_segments_null_group(src):
    got = set(spark_rows(weekly.wau_week(CFG, src), ["division_week", "os_type", "country_code", "wau"]))
    w = d("2023-12-31")
    assert got == {(w, 5, "05", 2), (w, 7, "09", 1), (w, 3, "03", 1), (w, None, None, 1)}


def test_sales_day_two_level(src):
    got = set(
        spark_rows(
            daily.sales_day(CFG, src),
            ["division_date", "os_type", "country_code", "market", "product_idx", "user_count", "sales_count", "real_cash_kr"],
        )
    )
    assert got == {
        (d("2024-01-03"), 5, "05", 0, 10, 1, 2, Decimal("15.50")),
        (d("2024-01-04"), 7, "09", 1, 11, 1, 1, Decimal("3.00")),
        (d("2024-01-05"), 4, "05", 0, 12, 1, 1, Decimal("2.00")),
        (d("2024-01-08"), 6, "06", 0, 10, 1, 1, Decimal("1.25")),
    }


def test_pu_week_tie_break_smallest_segment(src):
    got = set(spark_rows(weekly.pu_week(CFG, src), ["division_week", "os_type", "country_code", "pu"]))
    assert got == {(d("2023-12-31"), 4, "05", 1), (d("2023-12-31"), 7, "09", 1)}


def test_sales_week_parity_user_count_is_one(src):
    got = set(
        spark_rows(
            weekly.sales_week(CFG, src),
            ["division_week", "os_type", "country_code", "market", "product_idx", "user_count", "sales_count", "real_cash_kr"],
        )
    )
    w = d("2023-12-31")
    assert got == {
        (w, 5, "05", 0, 10, 1, 2, Decimal("15.50")),
        (w, 7, "09", 1, 11, 1, 1, Decimal("3.00")),
        (w, 4, "05", 0, 12, 1, 1, Decimal("2.00")),
    }


def test_ru_day_dense_spine_null_segments_zero(src):
    got = set(spark_rows(daily.ru_day(CFG, src), ["division_date", "os_type", "country_code", "date_count", "sum_date_count"]))
    exp = set()
    for day in ("2024-01-02", "2024-01-03", "2024-01-04"):
        for os_, cc in ((1, "01"), (None, "02"), (2, "03")):
            exp.add((d(day), os_, cc, 0, 0))
    exp -= {(d("2024-01-03"), 1, "01", 0, 0), (d("2024-01-04"), 1, "01", 0, 0), (d("2024-01-04"), 2, "03", 0, 0)}
    exp |= {(d("2024-01-03"), 1, "01", 1, 1), (d("2024-01-04"), 1, "01", 0, 1), (d("2024-01-04"), 2, "03", 1, 1)}
    assert got == exp


def test_retention_null_cohort_measures_and_offsets(src):
    df = daily.retention_day(CFG, src)
    rows = {(r["division_date"], r["os_type"], r["country_code"]): r for r in df.collect()}
    assert set(rows) == {
        (d("2024-01-02"), 1, "01"),
        (d("2024-01-03"), 1, "01"),
        (d("2024-01-03"), None, "02"),
        (d("2024-01-04"), 2, "03"),
    }
    m1 = rows[(d("2024-01-03"), 1, "01")]
    assert m1["user_count"] == 1
    assert [m1[f"user_{k}"] for k in range(1, 31)] == [1 if k == 2 else 0 for k in range(1, 31)]
    sales = {k: m1[f"sales_{k}"] for k in range(31)}
    assert sales[0] == Decimal("15.50") and sales[2] == Decimal("2.00") and sales[5] == Decimal("1.25")
    assert all(v == 0 for k, v in sales.items() if k not in (0, 2, 5))
    null_cohort = rows[(d("2024-01-03"), None, "02")]
    assert null_cohort["user_count"] == 1
    assert all(null_cohort[f"user_{k}"] is None for k in range(1, 31))
    assert all(null_cohort[f"sales_{k}"] is None for k in range(31))
    quiet = rows[(d("2024-01-02"), 1, "01")]
    assert quiet["user_count"] == 1 and quiet["user_1"] == 0 and quiet["sales_0"] == 0
