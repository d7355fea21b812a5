"""Partitioned summary tables, claims and crashes; the ledger of reduced days; state kept between runs."""

import os
import re
import tempfile
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daybook.config import FIXTURE_CONFIG as CFG
from daybook.functions.calendar import partition_range, scan_days
from daybook.plans import daily, ledger, runner
from daybook.sources import sinks
from daybook.sources.fixtures import fixture_sources
from daybook.sources.sinks import TableStore
from helpers import d, spark_rows

SCHEMA = "game_code string, division_date date, os_type int, v bigint"
KEYS = ["game_code", "division_date", "os_type"]


def _store(spark):
    return TableStore(spark, tempfile.mkdtemp(prefix="daybook-store-"))


def _rows(spark, *rows):
    return spark.createDataFrame([(g, d(x), o, v) for g, x, o, v in rows], SCHEMA)


def _files(store, table):
    top = store.parts(table).replace("file:", "")
    return {os.path.relpath(os.path.join(at, f), top) for at, _, names in os.walk(top) for f in names if f.endswith(".parquet")}


def _put(store, df, cutoff, game="g"):
    return store.replace("t", df, game, d(cutoff), KEYS, "division_date")


def test_replace_touches_only_its_months(spark):
    store = _store(spark)
    landed = _put(store, _rows(spark, ("g", "2024-01-05", 1, 1), ("g", "2024-02-05", 1, 2), ("g", "2024-02-20", None, 3), ("g", "2024-03-01", 1, 4)), "2024-01-01")
    assert (landed.rows, landed.latest, landed.version) == (4, d("2024-03-01"), 1)
    _put(store, _rows(spark, ("h", "2024-02-05", 1, 9)), "2024-02-01", game="h")
    before = _files(store, "t")
    # a NULL segment below the cutoff is replaced, March vanishes, the other game stays
    _put(store, _rows(spark, ("g", "2024-02-20", None, 30), ("g", "2024-02-25", 2, 5)), "2024-02-22")
    got = {(r["game_code"], str(r["division_date"]), r["os_type"], r["v"]) for r in store.read("t").collect()}
    assert got == {("g", "2024-01-05", 1, 1), ("g", "2024-02-05", 1, 2), ("g", "2024-02-20", None, 30), ("g", "2024-02-25", 2, 5), ("h", "2024-02-05", 1, 9)}
    after = _files(store, "t")
    kept = {f for f in before if "part_game=g-h" in f or "2024-01" in f}
    assert kept <= after and not any("2024-03" in f for f in after)
    assert store.versions("t") == [1, 2, 3] and store.vacuum("t", keep=1) == [1, 2]


def test_a_game_and_range_prune_partitions(spark):
    store = _store(spark)
    _put(store, _rows(spark, ("001", "2024-01-05", 1, 1), ("001", "2024-02-05", 1, 2)), "2024-01-01", game="001")
    _put(store, _rows(spark, ("1", "2024-01-05", 1, 3)), "2024-01-01", game="1")
    part = store.read("t", game="001", lo=d("2024-02-01"), hi=d("2024-02-29"))
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "part_game" in filters and "part_month" in filters
    assert [tuple(r) for r in part.collect()] == [("001", d("2024-02-05"), 1, 2)]  # codes stay strings


def test_empty_result_writes_nothing(spark):
    store = _store(spark)
    assert _put(store, _rows(spark, ("g", "2024-01-05", 1, 1)).filter("v > 5"), "2024-01-01") is None
    assert not store.exists("t") and store.versions("t") == []


def test_two_games_commit_at_once(spark, monkeypatch):
    """Both take a number before either swaps: each keeps its own number and partitions."""
    store, other = _store(spark), None
    other = TableStore(spark, store.root)
    move, done = sinks.move, []

    def between(spark_, source, target):
        if "/_pending/" in target and not done:
            done.append(True)
            _put(other, _rows(spark, ("h", "2024-01-05", 1, 2)), "2024-01-01", game="h")
        return move(spark_, source, target)

    monkeypatch.setattr(sinks, "move", between)
    _put(store, _rows(spark, ("g", "2024-01-05", 1, 1)), "2024-01-01")
    assert {r["game_code"] for r in store.read("t").collect()} == {"g", "h"} and store.versions("t") == [1, 2]


def test_a_crash_between_the_swaps_is_finished_by_the_next_writer(spark, monkeypatch):
    store = _store(spark)
    _put(store, _rows(spark, ("g", "2024-01-05", 1, 1), ("g", "2024-02-05", 1, 2)), "2024-01-01")
    move, swapped = sinks.move, []

    def dies(spark_, source, target):
        if "/_pending/" in source and "/parts/" in target:
            if swapped:
                raise OSError("crash")
            swapped.append(target)
        return move(spark_, source, target)

    with monkeypatch.context() as m:
        m.setattr(sinks, "move", dies)
        with pytest.raises(OSError):
            _put(store, _rows(spark, ("g", "2024-01-05", 1, 10), ("g", "2024-02-05", 1, 20)), "2024-01-01")
    _put(store, _rows(spark, ("h", "2024-01-05", 1, 3)), "2024-01-01", game="h")
    assert {(r["game_code"], r["v"]) for r in store.read("t").collect()} == {("g", 10), ("g", 20), ("h", 3)}


def test_whole_versions_become_partitions(spark):
    store = _store(spark)
    store.commit("t", _rows(spark, ("g", "2024-01-05", 1, 1), ("g", "2024-02-05", 1, 2), ("h", "2024-02-05", 1, 3)))
    _put(store, _rows(spark, ("g", "2024-02-06", 1, 4)), "2024-02-01")
    assert sorted(r["v"] for r in store.read("t").collect()) == [1, 3, 4]


def test_a_claimed_version_is_taken_once(spark):
    store = _store(spark)
    assert sinks.create_file(spark, f"{store.path('t')}/v=1/_claim")  # a writer that is still at it
    assert store.commit("t", spark.range(3)) == 2 and store.read("t").count() == 3


@pytest.mark.parametrize(("layout", "columns"), [("dt", "dt"), ("ymd", "yyyy mm dd"), ("ym2", "yyyy mm"), ("ym", "ym")])
def test_partition_layouts(spark, layout, columns):
    days = spark.range(120).select(F.expr("timestamp_ntz'2023-11-10 12:00:00' + make_interval(0, 0, 0, cast(id as int))").alias("ts"), "id")
    day = F.to_date("ts")
    parts = {"dt": day, "yyyy": F.year("ts"), "mm": F.month("ts"), "dd": F.dayofmonth("ts"), "ym": F.date_format("ts", "yyyy-MM")}
    path = tempfile.mkdtemp(prefix="daybook-layout-") + "/log"
    days.withColumns({c: parts[c] for c in columns.split()}).write.partitionBy(*columns.split()).parquet(path)
    log = spark.read.parquet(path)
    got = scan_days(log, "ts", date(2023, 12, 30), date(2024, 1, 3))
    assert sorted(r["id"] for r in got.collect()) == [50, 51, 52, 53]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert columns.split()[0] in re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    kept = log.where(partition_range(log.columns, date(2023, 12, 30), date(2024, 1, 3))).select(*columns.split()).distinct().count()
    assert kept == {"dt": 4, "ymd": 4, "ym2": 2, "ym": 2}[layout]
    assert partition_range(["ts"], date(2024, 1, 1), date(2024, 1, 2)) is None


def test_ledger_days():
    day = lambda k: date(2024, 1, k)
    known = {day(k): ledger.DayState(5) for k in range(1, 11)} | {day(4): ledger.DayState(0), day(6): ledger.DayState(5, stale=True)}
    # an empty day is known, a stale one comes again, the newest overlaps
    assert ledger.days_to_reduce(known, day(2), day(13), overlap=1) == [day(6), day(10), day(11), day(12)]
    assert ledger.days_to_reduce(known, day(2), day(13), overlap=3) == [day(6), day(8), day(9), day(10), day(11), day(12)]
    assert ledger.days_to_reduce({}, day(2), day(4), overlap=1) == [day(2), day(3)]


def _log(src, name, keep):
    ts = runner.LOG_TS[name]
    return src.replace(**{name: getattr(src, name).filter(keep(F.to_date(ts)))})


def test_rare_jobs_empty_days_and_expired_rows(spark):
    """Rare jobs hold no log back, an empty day doesn't widen the next run, and expired raw days stay reduced."""
    src = fixture_sources(spark, "/root/testdata/sf0.001")
    src = _log(src, "login", lambda x: x != F.lit(date(2024, 1, 9)))  # nobody on the 9th
    store, want = _store(spark), runner.reduce_logs(src, date(2024, 1, 1), date(2024, 1, 20))
    runner.refresh_reductions(spark, store, src, "g", date(2024, 1, 1), date(2024, 1, 16))
    known = ledger.read_ledger(store, "g")
    assert known["login"][date(2024, 1, 9)].rows == 0 and known["login"][date(2024, 1, 8)].rows > 0
    assert max(known["tutorial_end"]) == date(2024, 1, 15)  # known through, whatever has rows
    recent = src
    for name in runner.LOG_TS:
        recent = _log(recent, name, lambda x: x >= F.lit(date(2024, 1, 15)))
    seen = {}
    got = runner.refresh_reductions(spark, store, recent, "g", date(2024, 1, 1), date(2024, 1, 20), reduced=seen)
    assert seen["login"] == [date(2024, 1, k) for k in range(15, 20)]
    for name in runner.LOG_TS:
        assert spark_rows(getattr(got, name)) == spark_rows(getattr(want, name)), name
    # asked for all days once more, from logs that no longer hold them
    got = runner.refresh_reductions(spark, store, recent, "g", date(2024, 1, 1), date(2024, 1, 20), date(2024, 1, 1))
    for name in runner.LOG_TS:
        assert spark_rows(getattr(got, name)) == spark_rows(getattr(want, name)), name


def test_late_rows_of_a_stale_day_are_reduced(spark):
    src = fixture_sources(spark, "/root/testdata/sf0.001")
    store, lo, hi = _store(spark), date(2024, 1, 1), date(2024, 1, 16)
    runner.refresh_reductions(spark, store, _log(src, "billing", lambda x: x != F.lit(date(2024, 1, 5))), "g", lo, hi)
    assert ledger.read_ledger(store, "g")["billing"][date(2024, 1, 5)].rows == 0
    ledger.mark_stale(spark, store, "g", "billing", date(2024, 1, 4), date(2024, 1, 6))
    seen = {}
    got = runner.refresh_reductions(spark, store, src, "g", lo, hi, reduced=seen)
    assert seen["billing"] == [date(2024, 1, k) for k in (4, 5, 6, 15)] and seen["login"] == [date(2024, 1, 15)]
    assert spark_rows(got.billing) == spark_rows(runner.reduce_logs(src, lo, hi).billing)


def test_state_between_runs(spark):
    """With rescan="recent", month masks and last-seen days are kept; three runs equal one, each reading only what is new."""
    src = fixture_sources(spark, "/root/testdata/sf0.01")
    jobs = [j for j in runner.DAILY_JOBS if j.table in ("dau_day", "pu_day", "rau_day")]
    store, full = _store(spark), _store(spark)
    for end in (date(2024, 1, 12), date(2024, 1, 20), date(2024, 1, 31)):
        before = store.read("bookmark").collect() if store.exists("bookmark") else []
        start = max((date.fromisoformat(r["value"]) for r in before), default=date(2024, 1, 1))
        cut = src
        for name in runner.LOG_TS:  # raw rows older than a day before the newest bookmark have expired
            cut = _log(cut, name, lambda x, s=start: x >= F.lit(s - timedelta(days=1)))
        runner.run_jobs(spark, store, cut, CFG.replace(as_of=datetime(end.year, end.month, end.day)), jobs, rescan="recent")
    runner.run_jobs(spark, full, src, CFG, jobs)
    for job in jobs:
        assert spark_rows(store.read(job.table)) == spark_rows(full.read(job.table)), job.table
    assert store.part_names(runner.LAST_SEEN, CFG.game_code) == {"d-2024-01-29"}
    assert store.part_names("login_masks", CFG.game_code) == {"m-2023-12", "m-2024-01"}  # December is empty


def test_upstream_marks_bound_the_report(spark):
    src = fixture_sources(spark, "/root/testdata/sf0.001")
    store = _store(spark)
    marks = [(CFG.game_code, "login", "dms", "2024-01-20 10:30:00"), (CFG.game_code, "billing", "dms", "2024-01-18 00:00:00")]
    store.replace_game("dms", spark.createDataFrame(marks, "game_code string, job string, kind string, value string"), CFG.game_code)
    jobs = [j for j in runner.DAILY_JOBS if j.table in ("dau_day", "sales_day", "retention_day", "nru_day")]
    out = runner.run_jobs(spark, store, src, CFG, jobs, landed_only=True)
    assert out["dau_day"] == "2024-01-19" and out["sales_day"] == "2024-01-17"
    want = daily.dau_day(CFG.replace(as_of=datetime(2024, 1, 20)), src)
    assert spark_rows(store.read("dau_day")) == spark_rows(want)


def test_one_pass_a_metric(spark):
    """Guard and bookmark come from the job that writes: a first commit takes one job more than the metric alone, the rebalance."""
    src = fixture_sources(spark, "/root/testdata/sf0.001")
    store, tracker, result = _store(spark), spark.sparkContext.statusTracker(), daily.sales_day(CFG, src)

    def jobs(name, action):
        spark.sparkContext.setJobGroup(name, "")
        try:
            return action(), len(tracker.getJobIdsForGroup(name))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    _, alone = jobs("alone", lambda: result.write.format("noop").mode("overwrite").save())
    keys = runner.DAY_KEYS + runner.SALES_EXTRA
    landed, committed = jobs("committed", lambda: store.replace("sales_day", result, CFG.game_code, d("2024-01-01"), keys, "division_date"))
    assert landed.rows == store.read("sales_day").count() and committed <= alone + 1
