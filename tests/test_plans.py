"""Physical-plan properties that matter at scale, checked on every metric.

Sources are stored like production: logs partitioned by local date ``dt``.
"""

import re
import tempfile

import pytest

from daybook.config import FIXTURE_CONFIG as CFG
from daybook.plans import catalog, daily, weekly
from daybook.sources.fixtures import fixture_sources
from daybook.sources.tables import read_sources, write_sources

LOGS = ("login", "billing", "tutorial_end")
LOG_METRICS = [m for m in catalog.METRICS if m not in ("nru_day", "nru_week", "ru_day")]


@pytest.fixture(scope="module")
def stored(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # untruncated scan details
    root = tempfile.mkdtemp(prefix="daybook-plans-")
    write_sources(fixture_sources(spark, "/root/testdata/sf0.001"), root)
    return root, read_sources(spark, root)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan, root):
    """(table, scan text) for every parquet scan in the plan."""
    out = []
    for m in re.finditer(r"FileScan parquet \[.*", plan):
        line = m.group(0)
        t = re.search(re.escape(root) + r"/(\w+)\]", line)
        out.append((t.group(1) if t else "?", line))
    return out


@pytest.mark.parametrize("name", catalog.METRICS)
def test_no_pairwise_joins_or_python(stored, name):
    root, src = stored
    plan = _plan(catalog.metric(name, CFG, src))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in plan, bad


@pytest.mark.parametrize("name", ["dau_day", "pu_day"])
def test_month_to_date_uses_hash_aggregates_only(stored, name):
    plan = _plan(catalog.metric(name, CFG, stored[1]))
    assert "HashAggregate" in plan
    for bad in ("ObjectHashAggregate", "SortAggregate"):
        assert bad not in plan, bad


def test_rau_week_pushes_date_bounds_to_a_stored_rau_day(stored, spark):
    root, src = stored
    path = tempfile.mkdtemp(prefix="daybook-rau-") + "/rau_day"
    daily.rau_day(CFG, src).write.parquet(path)
    plan = _plan(weekly.rau_week(CFG, spark.read.parquet(path)))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "GreaterThanOrEqual(division_date" in pushed and "LessThan(division_date" in pushed


def test_pu_week_reduces_by_hash_before_the_tie_break(stored):
    plan = _plan(weekly.pu_week(CFG, stored[1]))
    lowest = [line for line in plan.splitlines() if "Aggregate(" in line][-1]
    assert "HashAggregate(" in lowest and "SortAggregate(" not in lowest


@pytest.mark.parametrize("name", LOG_METRICS)
def test_log_scans_prune_partitions_and_push_filters(stored, name):
    root, src = stored
    scans = _scans(_plan(catalog.metric(name, CFG, src)), root)
    logs = [(t, s) for t, s in scans if t in LOGS]
    assert logs, "metric reads no log"
    for table, scan in logs:
        part = re.search(r"PartitionFilters: \[([^\]]*)\]", scan).group(1)
        assert "dt#" in part, (table, part)
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", scan).group(1)
        assert "GreaterThanOrEqual" in pushed and "LessThan" in pushed, (table, pushed)


@pytest.mark.parametrize(
    "name,table,absent",
    [
        ("wau_week", "login", ["login_day_seq"]),
        ("rau_day", "login", ["os_type", "country_code"]),
        ("pu_day", "billing", ["os_type", "market", "product_id", "amount"]),
        ("eru_day", "tutorial_end", ["os_type", "country_code"]),
        ("nru_day", "member", []),
    ],
)
def test_column_pruning(stored, name, table, absent):
    root, src = stored
    scans = [s for t, s in _scans(_plan(catalog.metric(name, CFG, src)), root) if t == table]
    assert scans
    for scan in scans:
        schema = re.search(r"ReadSchema: (struct<[^>]*>)", scan).group(1)
        for col in absent:
            assert f"{col}:" not in schema, (name, table, schema)


def test_member_window_pushes_to_scan(stored):
    root, src = stored
    scans = [s for t, s in _scans(_plan(catalog.metric("nru_day", CFG, src)), root) if t == "member"]
    assert any("GreaterThanOrEqual(reg_utc" in s for s in scans)


@pytest.fixture(scope="module")
def colocated(spark):
    from daybook.plans import runner
    from daybook.session import checkpoint_dir

    src = fixture_sources(spark, "/root/testdata/sf0.001")
    lo, hi = runner.scan_window([CFG])
    red, tables, _ = runner.colocate(spark, runner.reduce_logs(src, lo, hi), f"{checkpoint_dir(spark)}/plans-work", 4)
    yield red
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {t}")


@pytest.mark.parametrize("name", catalog.METRICS)
def test_colocated_sources_need_no_member_shuffle(spark, colocated, name):
    """With sources bucketed by member and the runner's session settings, no
    metric shuffles on member_id: joins and member-level distincts are
    co-partitioned."""
    from daybook.plans import runner

    settings = dict(runner.RUN_CONF, **{"spark.sql.autoBroadcastJoinThreshold": "-1"})  # sort-merge joins, as at scale
    with runner.session_conf(spark, settings):
        plan = _plan(catalog.metric(name, CFG, colocated))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert not [k for k in keys if "member_id" in k], keys


def _scans_of(plan: str, table: str) -> int:
    return len(re.findall(rf"Location: InMemoryFileIndex[^\n]*/{table}\]", plan))


def test_retention_reads_each_table_once(spark, stored):
    """One scan a table and five hash exchanges at most: both logs' member-days, the cohort's two sides, the result."""
    from daybook.plans import runner

    root, src = stored
    with runner.session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = _plan(catalog.metric("retention_day", CFG, src))
    assert [_scans_of(plan, t) for t in ("member", "profile", "login", "billing")] == [1, 1, 1, 1]
    assert plan.count("Exchange hashpartitioning") <= 5


@pytest.mark.parametrize(("name", "log"), [("dau_day", "login"), ("pu_day", "billing")])
def test_month_to_date_reads_its_log_once(spark, stored, name, log):
    root, src = stored
    plan = _plan(catalog.metric(name, CFG, src))
    assert _scans_of(plan, log) == 1
    assert plan.count("Generate posexplode(filter(") == 1  # members spread into the days they were active, no others
