"""Incremental layer: replace_range, bookmarks, seeded running totals, and the
runner (two incremental runs equal one full run; a rerun changes nothing)."""

import tempfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from daybook.config import FIXTURE_CONFIG as CFG
from daybook.operators.incremental import (
    BOOKMARK_SCHEMA,
    advance_bookmark,
    empty_bookmarks,
    read_bookmark,
    replace_range,
)
from daybook.plans import daily, runner
from daybook.sources.fixtures import fixture_sources
from daybook.sources.sinks import TableStore
from helpers import d, spark_rows

SCHEMA = "game_code string, division_date date, os_type int, country_code string, dau bigint"
KEYS = ["game_code", "division_date", "os_type", "country_code"]


def test_replace_range(spark):
    existing = spark.createDataFrame(
        [
            ("g", d("2024-01-01"), 1, "01", 10),  # before cutoff, key not in new: kept
            ("g", d("2024-01-02"), 1, "01", 20),  # before cutoff, key in new: replaced
            ("g", d("2024-01-03"), None, "02", 30),  # NULL-segment key in new: replaced
            ("g", d("2024-01-04"), 1, "01", 40),  # at/after cutoff, vanished: removed
            ("h", d("2024-01-04"), 1, "01", 50),  # other game: kept
        ],
        SCHEMA,
    )
    new = spark.createDataFrame(
        [("g", d("2024-01-02"), 1, "01", 21), ("g", d("2024-01-03"), None, "02", 31), ("g", d("2024-01-05"), 2, "03", 61)],
        SCHEMA,
    )
    got = spark_rows(replace_range(existing, new, "g", d("2024-01-03"), KEYS, "division_date"))
    assert got == spark_rows(
        spark.createDataFrame(
            [
                ("g", d("2024-01-01"), 1, "01", 10),
                ("g", d("2024-01-02"), 1, "01", 21),
                ("g", d("2024-01-03"), None, "02", 31),
                ("g", d("2024-01-05"), 2, "03", 61),
                ("h", d("2024-01-04"), 1, "01", 50),
            ],
            SCHEMA,
        )
    )
    # applying the same replacement again changes nothing
    once = replace_range(existing, new, "g", d("2024-01-03"), KEYS, "division_date")
    twice = replace_range(once, new, "g", d("2024-01-03"), KEYS, "division_date")
    assert spark_rows(once) == spark_rows(twice)


def test_bookmarks(spark):
    marks = empty_bookmarks(spark)
    assert read_bookmark(marks, "g", "dau", "day", "2024-01-01") == "2024-01-01"
    result = spark.createDataFrame([("g", d("2024-01-05"), 1, "01", 1), ("g", d("2024-01-07"), 1, "01", 1)], SCHEMA)
    marks = advance_bookmark(marks, "g", "dau", "day", result, "division_date")
    assert read_bookmark(marks, "g", "dau", "day", "x") == "2024-01-07"
    # an empty result leaves the bookmark alone
    marks = advance_bookmark(marks, "g", "dau", "day", result.limit(0), "division_date")
    assert read_bookmark(marks, "g", "dau", "day", "x") == "2024-01-07"
    marks = advance_bookmark(marks, "g", "pu", "day", result.filter("division_date < '2024-01-06'"), "division_date")
    assert sorted(tuple(r) for r in marks.collect()) == [("g", "dau", "day", "2024-01-07"), ("g", "pu", "day", "2024-01-05")]


@pytest.fixture(scope="module")
def sf01_src(spark):
    return fixture_sources(spark, "/root/testdata/sf0.1")


@pytest.mark.parametrize("seed_day", ["2024-01-13", "2024-01-05"])
def test_ru_day_incremental_equals_full_run(sf01_src, seed_day):
    """The corrected seed carries totals even when the seed day had no sign-ups
    (2024-01-13 at sf0.1)."""
    seed = d(seed_day)
    prior = daily.ru_day(CFG.replace(as_of=datetime(seed.year, seed.month, seed.day + 1)), sf01_src)
    nxt = CFG.replace(start=date(seed.year, seed.month, seed.day + 1))
    inc = daily.ru_day_incremental(nxt, sf01_src, prior)
    full = daily.ru_day(CFG, sf01_src).filter(F.col("division_date") > F.lit(seed))
    assert inc.count() > 0
    assert spark_rows(inc) == spark_rows(full)


def test_ru_day_reference_seed_is_lost_without_signups(sf01_src):
    """Reference quirk: a seed day without sign-ups is not in the spine, so the
    carried totals restart at zero."""
    prior = daily.ru_day(CFG.replace(as_of=datetime(2024, 1, 14)), sf01_src)
    seeded = daily.ru_day(CFG.replace(start=date(2024, 1, 14)), sf01_src, prior)
    full = daily.ru_day(CFG, sf01_src).filter(F.col("division_date") > F.lit(date(2024, 1, 13)))
    got = seeded.agg(F.max("sum_date_count")).first()[0]
    assert got < full.agg(F.max("sum_date_count")).first()[0]


def test_mid_month_start_matches_full_run(sf01_src):
    mid = CFG.replace(start=date(2024, 1, 15))
    for fn in (daily.dau_day, daily.pu_day):
        inc = fn(mid, sf01_src)
        full = fn(CFG, sf01_src).filter(F.col("division_date") >= F.lit(date(2024, 1, 15)))
        assert spark_rows(inc) == spark_rows(full)


def _tables(store: TableStore):
    return {job.table: spark_rows(store.read(job.table)) for job in runner.DAILY_JOBS + runner.WEEKLY_JOBS}


def test_runner_incremental_equals_full_and_rerun_is_idempotent(spark, full_store_sf0001):
    src = fixture_sources(spark, "/root/testdata/sf0.001")
    full = full_store_sf0001

    inc = TableStore(spark, tempfile.mkdtemp(prefix="daybook-inc-"))
    first = CFG.replace(as_of=datetime(2024, 1, 16))
    marks1 = runner.run_daily(spark, inc, src, first)
    runner.run_weekly(spark, inc, src, first)
    assert marks1["dau_day"] == "2024-01-15"
    marks2 = runner.run_daily(spark, inc, src, CFG)
    runner.run_weekly(spark, inc, src, CFG)
    assert marks2["dau_day"] == "2024-01-30"

    want = _tables(full)
    got = _tables(inc)
    for table in want:
        assert got[table] == want[table], table

    versions = inc.versions("dau_day")
    runner.run_daily(spark, inc, src, CFG)
    runner.run_weekly(spark, inc, src, CFG)
    assert inc.versions("dau_day") == versions + [versions[-1] + 1]
    assert _tables(inc) == want
    assert spark_rows(inc.read("bookmark")) == spark_rows(full.read("bookmark"))
    assert inc.read("bookmark").schema == BOOKMARK_SCHEMA


def test_runner_csv_backups(spark):
    src = fixture_sources(spark, "/root/testdata/sf0.001")
    store = TableStore(spark, tempfile.mkdtemp(prefix="daybook-bk-"))
    backups = tempfile.mkdtemp(prefix="daybook-csv-")
    jobs = [j for j in runner.DAILY_JOBS if j.table in ("nru_day", "dau_day")]
    runner.run_jobs(spark, store, src, CFG, jobs, backup_root=backups)
    nru_rows = spark.read.option("header", True).csv(f"{backups}/nru_backup/2024-01-01")
    assert nru_rows.columns == ["division_date", "member_id", "os_type", "country_code", "member_name"]
    assert nru_rows.count() == daily.nru_backup_rows(CFG, src).count() > 0
    dau = spark.read.option("header", True).csv(f"{backups}/dau_backup/2024-01-01")
    assert dau.count() == store.read("dau_day").count() > 0


def test_two_games_share_a_store(spark):
    src = fixture_sources(spark, "/root/testdata/sf0.001")
    store = TableStore(spark, tempfile.mkdtemp(prefix="daybook-games-"))
    jobs = [j for j in runner.DAILY_JOBS if j.table in ("nru_day", "sales_day")]
    runner.run_jobs(spark, store, src, CFG.replace(game_code="g1"), jobs)
    runner.run_jobs(spark, store, src, CFG.replace(game_code="g2"), jobs)
    # a rerun of g1 replaces only g1's range
    runner.run_jobs(spark, store, src, CFG.replace(game_code="g1"), jobs)
    for table in ("nru_day", "sales_day"):
        df = store.read(table)
        g1 = spark_rows(df.filter("game_code = 'g1'").drop("game_code"))
        g2 = spark_rows(df.filter("game_code = 'g2'").drop("game_code"))
        assert g1 == g2 and len(g1) > 0
    marks = {(r["game_code"], r["job"]) for r in store.read("bookmark").collect()}
    assert marks == {("g1", "nru"), ("g1", "sales"), ("g2", "nru"), ("g2", "sales")}


def test_command_line_daily_run(spark):
    from daybook.__main__ import main
    from daybook.sources.tables import write_sources

    root = tempfile.mkdtemp(prefix="daybook-cli-")
    write_sources(fixture_sources(spark, "/root/testdata/sf0.001"), f"{root}/sources")
    out = main(["daily", "--sources", f"{root}/sources", "--store", f"{root}/store", "--game", "game01",
                "--as-of", "2024-01-31 00:00", "--start", "2024-01-01"])
    assert out["dau_day"] == "2024-01-30" and out["retention_day"] == "2024-01-04"
    store = TableStore(spark, f"{root}/store")
    assert spark_rows(store.read("dau_day")) == spark_rows(daily.dau_day(CFG, fixture_sources(spark, "/root/testdata/sf0.001")))


def test_runner_across_month_boundaries(spark):
    """Orders fixture: a run as of 1995-12-16 then one as of 1996-03-01 equal a
    single run; the second run's month-to-date, cohorts and weeks cross months
    and the new year."""
    from daybook.plans.catalog import CFG_MONTHS
    from daybook.sources.fixtures import fixture_sources_orders

    src = fixture_sources_orders(spark, "/root/testdata/sf0.001")
    full = TableStore(spark, tempfile.mkdtemp(prefix="daybook-mfull-"))
    runner.run_daily(spark, full, src, CFG_MONTHS)
    runner.run_weekly(spark, full, src, CFG_MONTHS)
    inc = TableStore(spark, tempfile.mkdtemp(prefix="daybook-minc-"))
    first = CFG_MONTHS.replace(as_of=datetime(1995, 12, 16))
    runner.run_daily(spark, inc, src, first)
    runner.run_weekly(spark, inc, src, first)
    runner.run_daily(spark, inc, src, CFG_MONTHS)
    runner.run_weekly(spark, inc, src, CFG_MONTHS)
    want, got = _tables(full), _tables(inc)
    for table in want:
        assert got[table] == want[table], table
    assert len(want["dau_day"]) > 0 and len(want["wau_week"]) > 0


def test_vacuum_keeps_newest_versions(spark):
    import os

    store = TableStore(spark, tempfile.mkdtemp(prefix="daybook-vac-"))
    for i in range(5):
        store.commit("t", spark.createDataFrame([(i,)], "x int"))
    assert store.versions("t") == [1, 2, 3, 4, 5]
    assert store.vacuum("t", keep=2) == [1, 2, 3]
    assert sorted(os.listdir(store.path("t"))) == ["v=4", "v=5"]
    assert TableStore(spark, store.root).versions("t") == [4, 5]  # a fresh store lists the same
    assert store.read("t").first()["x"] == 4
    assert store.commit("t", spark.createDataFrame([(9,)], "x int")) == 6


def test_runner_cleans_its_work_folder_and_bounds_versions(spark):
    import os

    from daybook.session import checkpoint_dir

    src = fixture_sources(spark, "/root/testdata/sf0.001")
    store = TableStore(spark, tempfile.mkdtemp(prefix="daybook-clean-"))
    jobs = [j for j in runner.DAILY_JOBS if j.table == "sales_day"]
    for _ in range(3):
        runner.run_jobs(spark, store, src, CFG, jobs, keep_versions=2)
    assert store.versions("sales_day") == [2, 3]
    work = f"{checkpoint_dir(spark)}/daybook-work".replace("file:", "")
    assert not os.path.exists(work) or os.listdir(work) == []
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("daybook_work_")] == []


def test_second_run_reads_older_days_from_stored_reductions(spark, full_store_sf0001):
    """With rescan="recent", a later run needs raw log rows only from its first
    new report day on: feeding it logs cut before that day changes nothing."""
    src = fixture_sources(spark, "/root/testdata/sf0.001")
    full = full_store_sf0001

    inc = TableStore(spark, tempfile.mkdtemp(prefix="daybook-rinc-"))
    first = CFG.replace(as_of=datetime(2024, 1, 16))
    runner.run_daily(spark, inc, src, first, rescan="recent")
    runner.run_weekly(spark, inc, src, first, rescan="recent")
    # next runs: daily bookmark 2024-01-15 (first new day 01-15), weekly
    # bookmark 2024-01-07 (first new week 01-14): raw logs from 01-14 suffice
    cut = F.lit(date(2024, 1, 14))
    recent = src.replace(
        login=src.login.filter(F.to_date("login_ts") >= cut),
        billing=src.billing.filter(F.to_date("log_ts") >= cut),
        tutorial_end=src.tutorial_end.filter(F.to_date("log_ts") >= cut),
    )
    runner.run_daily(spark, inc, recent, CFG, rescan="recent")
    runner.run_weekly(spark, inc, recent, CFG, rescan="recent")
    want, got = _tables(full), _tables(inc)
    for table in want:
        assert got[table] == want[table], table


def test_window_rescan_sees_late_rows_for_older_days(spark):
    """Default mode: a late purchase for a day before the overlap reaches
    month-to-date payers and retention on the next run, as in the reference."""
    src = fixture_sources(spark, "/root/testdata/sf0.001")
    late_day = F.to_date("log_ts") == F.lit(date(2024, 1, 5))
    early = src.replace(billing=src.billing.filter(~late_day))
    store = TableStore(spark, tempfile.mkdtemp(prefix="daybook-late-"))
    jobs = [j for j in runner.DAILY_JOBS if j.table in ("pu_day", "retention_day")]
    runner.run_jobs(spark, store, early, CFG.replace(as_of=datetime(2024, 1, 16)), jobs)
    runner.run_jobs(spark, store, src, CFG, jobs)  # the 5th's rows have landed late
    full = TableStore(spark, tempfile.mkdtemp(prefix="daybook-late-full-"))
    runner.run_jobs(spark, full, src, CFG, jobs)
    pu = lambda st: spark_rows(st.read("pu_day").filter(F.col("division_date") >= F.lit(date(2024, 1, 15))))
    assert pu(store) == pu(full)
    assert spark_rows(store.read("retention_day")) == spark_rows(full.read("retention_day"))
