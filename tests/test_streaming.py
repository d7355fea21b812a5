"""Arrival tracking and arrival-driven refresh (late billing files)."""

import tempfile
from datetime import date, datetime

from pyspark.sql import functions as F

from daybook.config import FIXTURE_CONFIG as CFG
from daybook.plans import runner
from daybook.sources.fixtures import fixture_sources
from daybook.sources.sinks import TableStore
from daybook.sources.tables import SCHEMAS
from daybook.streaming.arrivals import arrivals, refresh, rewind_bookmarks
from helpers import spark_rows


def _day(c):
    return F.to_date(c)


def test_rewind_bookmarks(spark):
    marks = spark.createDataFrame(
        [("g", "dau", "day", "2024-01-20"), ("g", "pu", "day", "2024-01-05"), ("g", "wau", "week", "2024-01-21"), ("h", "dau", "day", "2024-01-20")],
        "game_code string, job string, kind string, value string",
    )
    out = rewind_bookmarks(marks, "g", "day", date(2024, 1, 10), before_days=1)
    out = rewind_bookmarks(out, "g", "week", date(2024, 1, 10), before_days=1)
    assert sorted(tuple(r) for r in out.collect()) == [
        ("g", "dau", "day", "2024-01-10"),
        ("g", "pu", "day", "2024-01-05"),
        ("g", "wau", "week", "2024-01-06"),
        ("h", "dau", "day", "2024-01-20"),
    ]


def test_late_billing_files_are_recomputed(spark, full_store_sf0001):
    base_src = fixture_sources(spark, "/root/testdata/sf0.001")
    billing_dir = tempfile.mkdtemp(prefix="daybook-billing-")
    ckpt = tempfile.mkdtemp(prefix="daybook-arrivals-")
    bill = base_src.billing.cache()
    d = _day("log_ts")

    src = base_src.replace(billing=spark.read.schema(SCHEMAS["billing"]).parquet(billing_dir))
    watched = {"billing": (billing_dir, SCHEMAS["billing"], "log_ts")}

    # batch A: up to 01-15, except the 10th, which lands late
    bill.filter((d <= F.lit(date(2024, 1, 15))) & (d != F.lit(date(2024, 1, 10)))).write.mode("append").parquet(billing_dir)
    assert arrivals(spark, billing_dir, SCHEMAS["billing"], "log_ts", f"{ckpt}/probe") == (date(2024, 1, 1), date(2024, 1, 15))
    assert arrivals(spark, billing_dir, SCHEMAS["billing"], "log_ts", f"{ckpt}/probe") is None

    store = TableStore(spark, tempfile.mkdtemp(prefix="daybook-store-"))
    src = src.replace(billing=spark.read.schema(SCHEMAS["billing"]).parquet(billing_dir))
    marks = refresh(spark, store, src, CFG.replace(as_of=datetime(2024, 1, 16)), watched, ckpt)
    assert marks["pu_day"] == "2024-01-15"

    # batch B: the late 10th and the rest of the month
    bill.filter((d > F.lit(date(2024, 1, 15))) | (d == F.lit(date(2024, 1, 10)))).write.mode("append").parquet(billing_dir)
    src = src.replace(billing=spark.read.schema(SCHEMAS["billing"]).parquet(billing_dir))
    marks = refresh(spark, store, src, CFG, watched, ckpt)
    assert marks["pu_day"] == "2024-01-30"
    assert refresh(spark, store, src, CFG, watched, ckpt) is None

    full = full_store_sf0001  # a full run over the same (complete) sources
    for job in runner.DAILY_JOBS + runner.WEEKLY_JOBS:
        assert spark_rows(store.read(job.table)) == spark_rows(full.read(job.table)), job.table


def test_failed_refresh_keeps_late_days(spark, monkeypatch):
    """A crash after the stream's checkpoint moved: the next call still rewinds to the late day, over the whole window."""
    import pytest

    root = tempfile.mkdtemp(prefix="daybook-crash-")
    store = TableStore(spark, f"{root}/store")
    store.commit("bookmark", spark.createDataFrame([(CFG.game_code, "pu", "day", "2024-01-20")], "game_code string, job string, kind string, value string"))
    row = (1, datetime(2024, 1, 10, 5), 1, "KR", 1, 1, None)
    spark.createDataFrame([row[: len(SCHEMAS["billing"])]], SCHEMAS["billing"]).write.parquet(f"{root}/billing")
    watched = {"billing": (f"{root}/billing", SCHEMAS["billing"], "log_ts")}
    modes = []
    commit = TableStore.commit

    def broken(self, table, df, partitions=None):
        if table == "bookmark":
            raise OSError("crash")
        return commit(self, table, df, partitions)

    for name in ("run_daily", "run_weekly"):
        monkeypatch.setattr(runner, name, lambda *a, rescan, **k: modes.append(rescan) or {})
    with monkeypatch.context() as m:
        m.setattr(TableStore, "commit", broken)
        with pytest.raises(OSError):
            refresh(spark, store, None, CFG, watched, f"{root}/ckpt")
    assert refresh(spark, store, None, CFG, watched, f"{root}/ckpt") == {}
    assert store.read("bookmark").first()["value"] == "2024-01-10" and modes == ["window", "window"]
    assert refresh(spark, store, None, CFG, watched, f"{root}/ckpt") is None


def test_recent_reductions_drop_vanished_days(spark):
    src = fixture_sources(spark, "/root/testdata/sf0.001")
    store = TableStore(spark, tempfile.mkdtemp(prefix="daybook-vanish-"))
    lo, hi, late = date(2024, 1, 5), date(2024, 1, 12), date(2024, 1, 8)
    src = src.replace(tutorial_end=src.tutorial_end.limit(0))  # a log without rows in the window
    runner.refresh_reductions(spark, store, src, "g", lo, hi, lo)
    src = src.replace(login=src.login.filter(_day("login_ts") != F.lit(late)))
    got, want = runner.refresh_reductions(spark, store, src, "g", lo, hi, late), runner.reduce_logs(src, lo, hi)
    for name in ("login", "billing", "tutorial_end"):
        assert spark_rows(getattr(got, name)) == spark_rows(getattr(want, name)), name
