"""Calendar helpers: Sunday weeks, months, hour shifts and window predicates."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.config import KpiConfig, month_start, sunday_week_start
from daybook.functions.calendar import day_range, local_date, scan_days, week_range, week_start


@pytest.mark.parametrize(
    "day,expected",
    [
        (date(2024, 1, 6), date(2023, 12, 31)),  # Saturday -> previous Sunday, across the year
        (date(2023, 12, 31), date(2023, 12, 31)),  # Sunday is its own week start
        (date(2024, 1, 1), date(2023, 12, 31)),  # Monday
        (date(2024, 3, 2), date(2024, 2, 25)),  # leap-year February
    ],
)
def test_week_start_python_and_spark_agree(spark, day, expected):
    assert sunday_week_start(day) == expected
    got = spark.createDataFrame([(day,)], "d date").select(week_start("d").alias("w")).first()["w"]
    assert got == expected


def test_month_start_rollover():
    assert month_start(date(2024, 1, 31)) == date(2024, 1, 1)
    cfg = KpiConfig(start=date(2024, 3, 1), before_days=1)
    assert cfg.day_lo == date(2024, 2, 29)
    assert cfg.month_lo == date(2024, 2, 1)


def test_hour_shift_over_midnight(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 15, 30),), (datetime(2024, 1, 1, 14, 59),)], "ts timestamp_ntz")
    got = sorted(r["d"] for r in df.select(local_date("ts", 9).alias("d")).collect())
    assert got == [date(2024, 1, 1), date(2024, 1, 2)]


def test_windows_from_config():
    cfg = KpiConfig(start=date(2024, 1, 1), before_days=1, week_start=date(2023, 12, 24), as_of=datetime(2024, 1, 31))
    assert (cfg.day_lo, cfg.day_hi) == (date(2023, 12, 31), date(2024, 1, 31))
    assert (cfg.week_lo, cfg.week_hi) == (date(2023, 12, 24), date(2024, 1, 28))
    assert cfg.rau_scan_lo == date(2023, 12, 25)
    assert cfg.retention_day_lo == date(2023, 11, 29)


def test_raw_column_predicates_match_derived_dates(spark):
    """day_range / week_range on the raw timestamp select exactly the rows whose
    shifted date / week lies in the window (checked hour by hour)."""
    base = datetime(2023, 12, 20)
    rows = [(base + timedelta(hours=h),) for h in range(24 * 40)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("ts", T.TimestampNTZType())]))
    lo, hi, tz = date(2023, 12, 31), date(2024, 1, 10), 9
    a = df.filter(day_range("ts", lo, hi, tz)).count()
    ld = local_date("ts", tz)
    b = df.filter((ld > F.lit(lo)) & (ld < F.lit(hi))).count()
    assert a == b == 9 * 24
    wlo, whi = date(2023, 12, 24), date(2024, 1, 14)
    a = df.filter(week_range("ts", wlo, whi, tz)).count()
    wk = week_start(ld)
    b = df.filter((wk > F.lit(wlo)) & (wk < F.lit(whi))).count()
    assert a == b == 14 * 24


def test_scan_days_adds_partition_filter(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2, 1), date(2024, 1, 2))], "ts timestamp_ntz, dt date")
    plan = scan_days(df, "ts", date(2024, 1, 1), date(2024, 1, 3))._jdf.queryExecution().optimizedPlan().toString()
    assert "dt#" in plan and "2024-01-01" in plan
