"""Commits, sources and scan windows under failures, foreign columns and late bookmarks."""

import tempfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from daybook.config import FIXTURE_CONFIG as CFG
from daybook.operators.incremental import replace_range
from daybook.plans import daily, runner
from daybook.sources.fixtures import fixture_sources
from daybook.sources.sinks import TableStore
from daybook.sources.tables import read_sources, write_sources


def test_failed_commit_does_not_block_a_retry(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="daybook-store-"))
    store.commit("t", spark.range(5))
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception):
        store.commit("t", broken)
    assert store.versions("t") == [1] and store.read("t").count() == 5
    store.commit("t", spark.range(7))
    assert TableStore(spark, store.root).read("t").count() == 7 and store.versions("t") == [1, 2]


def test_half_written_version_is_never_read(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="daybook-store-"))
    store.commit("t", spark.range(5))
    # what a job leaves that died before its commit: files without the mark
    spark.range(3).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{store.path('t')}/v=2/dead")
    assert store.versions("t") == [1] and store.read("t").count() == 5


def test_foreign_columns_have_no_effect(spark, sf001_dir):
    src = fixture_sources(spark, sf001_dir)
    root = tempfile.mkdtemp(prefix="daybook-src-")
    write_sources(src.replace(billing=src.billing.withColumn("n", F.lit(5))), root)
    read = read_sources(spark, root)
    assert "n" not in read.billing.columns
    total = lambda s: daily.sales_day(CFG, s).agg(F.sum("sales_count")).first()[0]
    assert total(read) == total(src) == total(src.replace(billing=src.billing.withColumn("n", F.lit(5))))


def test_each_log_is_read_from_its_own_first_day():
    late = CFG.replace(start=date(2026, 1, 30), week_start=date(2026, 1, 18), as_of=datetime(2026, 2, 2))
    cfgs = {j.table: late for j in [*runner.DAILY_JOBS, *runner.WEEKLY_JOBS]}
    lows = runner.log_windows(runner.DAILY_JOBS, cfgs)
    assert lows == {"login": late.retention_day_lo + runner.DAY, "billing": late.retention_day_lo + runner.DAY, "tutorial_end": date(2026, 1, 30)}
    far = {t: c.replace(week_start=date(2023, 12, 24)) for t, c in cfgs.items()}  # the other kind's default
    assert runner.log_windows(runner.DAILY_JOBS, far) == lows
    weekly = runner.log_windows(runner.WEEKLY_JOBS, {t: c.replace(start=date(2024, 1, 1)) for t, c in cfgs.items()})
    assert set(weekly.values()) == {date(2026, 1, 25)}


def test_replace_range_keeps_rows_without_a_date(spark):
    old = spark.createDataFrame([("g", None, 1), ("g", date(2024, 1, 1), 2), ("g", date(2024, 1, 9), 3), ("h", date(2024, 1, 9), 4)], "game_code string, d date, v int")
    new = spark.createDataFrame([("g", date(2024, 1, 9), 5), ("g", date(2024, 1, 1), 6)], old.schema)
    out = replace_range(old, new, "g", date(2024, 1, 5), ["game_code", "d"], "d")
    assert sorted(r["v"] for r in out.collect()) == [1, 4, 5, 6]


def test_two_games_keep_their_bookmarks(spark, sf001_dir):
    src = fixture_sources(spark, sf001_dir)
    root = tempfile.mkdtemp(prefix="daybook-store-")
    jobs = [j for j in runner.DAILY_JOBS if j.table in ("nru_day", "sales_day")]
    for game in ("a", "b"):
        runner.run_jobs(spark, TableStore(spark, root), src, CFG.replace(game_code=game), jobs)
    marks = TableStore(spark, root).read("bookmark").collect()
    assert {(r["game_code"], r["job"]) for r in marks} == {(g, j) for g in "ab" for j in ("nru", "sales")}
