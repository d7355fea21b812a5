"""Registered queries: every metric and incremental operator over the test tables.

Each entry takes ``(spark, sf_dir)``, derives the five sources from the
``events`` and ``customer`` tables with a Spark job and returns the metric's
DataFrame. ``oracle_statements()`` gives the matching independent DuckDB SQL.

Scenarios (all on the fixture configuration of FIXTURES.md section 3):

* full run: daily bookmark 2024-01-01, weekly 2023-12-24, report time
  2024-01-31 00:00;
* mid-month run (``*_incremental`` for dau/pu): daily bookmark 2024-01-15, so
  month-to-date counts must include activity before the first report day;
* seeded ``ru_day``: a first run as of 2024-01-05 stored, then a run from the
  seed day 2024-01-04 carrying its totals forward;
* ``replace_range``: sales as of 2024-01-20 stored, then a run from 2024-01-15
  merged in; the merge must equal the full run;
* ``bookmark_advance``: the bookmark table after all fourteen jobs;
* ``*_stateful``, ``*_masks``: the mid-month run from what an earlier run has to
  hand down alone: last-seen days, month masks merged with the new days';
* ``rau_day_first_run``: the mid-month run as the reference's first run;
* ``dau_day_landed``: the login log has landed up to 2024-01-20 10:00, and the
  report ends the day before its newest row;
* ``sales_day_replaced``: three commits to a partitioned table: two games and an
  older run with rows that must go, a later run of one game with a NULL
  segment and keys below its cutoff. All rows of both games are returned;
* ``rau_week_stored``: the roll-up of a stored ``rau_day`` that holds two games;
* ``sales_day_by_month``: billing stored in ``yyyy/mm`` partitions;
* ``bookmarks_kept``: filled bookmarks after a run with a job that finds nothing;
* ``*_months``: every metric on the second fixture (``orders`` + ``customer``)
  over the whole span of orders: daily reports 1995-01-01..2001-08-04, weekly
  reports 1995-01-01..2001-07-29.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import oracle
from daybook.config import FIXTURE_CONFIG, KpiConfig
from daybook.functions.calendar import ntz
from daybook.operators.incremental import advance_bookmark, empty_bookmarks, replace_range
from daybook.operators.last_seen import last_seen
from daybook.operators.month_to_date import merge_masks
from daybook.plans import daily, weekly
from daybook.plans.ledger import UPSTREAM, bounded
from daybook.session import checkpoint_dir
from daybook.sources.fixtures import fixture_sources, fixture_sources_orders
from daybook.sources.sinks import TableStore
from daybook.sources.tables import Sources

DAY = timedelta(days=1)
CFG = FIXTURE_CONFIG
# Fixed scenario dates (see module docstring).
MID_MONTH_START = date(2024, 1, 15)
RU_PRIOR_AS_OF = datetime(2024, 1, 5)
RU_INCREMENTAL_START = date(2024, 1, 5)
REPLACE_PRIOR_AS_OF = datetime(2024, 1, 20)
REPLACE_START = date(2024, 1, 15)
LANDED_UNTIL = datetime(2024, 1, 20, 10)
OTHER_GAME = "game02"

# Second fixture: a short window across month and year boundaries, for the runner's tests.
CFG_MONTHS = CFG.replace(start=date(1995, 11, 1), week_start=date(1995, 10, 29), as_of=datetime(1996, 3, 1))
# The registered window: all orders, 1995-01-01..2001-08-01, and the whole week of the last one.
CFG_SPAN = CFG_MONTHS.replace(start=date(1995, 1, 1), week_start=date(1994, 12, 25), as_of=datetime(2001, 8, 5))

CFG_MID = CFG.replace(start=MID_MONTH_START)
CFG_RU_PRIOR = CFG.replace(as_of=RU_PRIOR_AS_OF)
CFG_RU_NEXT = CFG.replace(start=RU_INCREMENTAL_START)

SALES_KEYS = ["game_code", "division_date", "os_type", "country_code", "market", "product_idx"]

# (job, kind, metric, date column) in the order the reference runners call them
BOOKMARK_JOBS = [
    ("nru", "day", "nru_day", "division_date"),
    ("dau", "day", "dau_day", "division_date"),
    ("pu", "day", "pu_day", "division_date"),
    ("eru", "day", "eru_day", "division_date"),
    ("rau", "day", "rau_day", "division_date"),
    ("sales", "day", "sales_day", "division_date"),
    ("ru", "day", "ru_day", "division_date"),
    ("retention", "day", "retention_day", "division_date"),
    ("nru", "week", "nru_week", "division_week"),
    ("wau", "week", "wau_week", "division_week"),
    ("pu", "week", "pu_week", "division_week"),
    ("eru", "week", "eru_week", "division_week"),
    ("rau", "week", "rau_week", "division_week"),
    ("sales", "week", "sales_week", "division_week"),
]


def present(df: DataFrame) -> DataFrame:
    """The cross-engine check form: dates as ISO strings, numbers as DOUBLE."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(f.dataType, T.NumericType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def metric(name: str, cfg: KpiConfig, src: Sources) -> DataFrame:
    """A metric by table name (``rau_week`` computes its ``rau_day`` input)."""
    if name == "rau_week":
        return weekly.rau_week(cfg, daily.rau_day(cfg, src))
    fn = getattr(daily, name, None) or getattr(weekly, name)
    return fn(cfg, src)


FIXTURES = {"events": fixture_sources, "orders": fixture_sources_orders}


def _simple(name: str, cfg: KpiConfig = CFG, fixture: str = "events") -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return metric(name, cfg, FIXTURES[fixture](spark, sf_dir, cfg.tz_offset_hours))

    run.__name__ = name
    return run


def ru_day_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixture_sources(spark, sf_dir, CFG.tz_offset_hours)
    prior = daily.ru_day(CFG_RU_PRIOR, src)
    return daily.ru_day_incremental(CFG_RU_NEXT, src, prior)


def ru_day_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixture_sources(spark, sf_dir, CFG.tz_offset_hours)
    prior = daily.ru_day(CFG_RU_PRIOR, src)
    return daily.ru_day(CFG_RU_NEXT, src, prior)


def replace_range_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixture_sources(spark, sf_dir, CFG.tz_offset_hours)
    stored = daily.sales_day(CFG.replace(as_of=REPLACE_PRIOR_AS_OF), src)
    fresh = daily.sales_day(CFG.replace(start=REPLACE_START), src)
    return replace_range(stored, fresh, CFG.game_code, REPLACE_START, SALES_KEYS, "division_date")


def bookmark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixture_sources(spark, sf_dir, CFG.tz_offset_hours)
    marks = empty_bookmarks(spark)
    for job, kind, name, col in BOOKMARK_JOBS:
        marks = advance_bookmark(marks, CFG.game_code, job, kind, metric(name, CFG, src), col)
    return marks


def rau_day_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixture_sources(spark, sf_dir, CFG.tz_offset_hours)
    state = last_seen(daily.first_login_days(CFG_MID, src, CFG.start, CFG_MID.day_lo + DAY))
    return daily.rau_day(CFG_MID.replace(rau_lookback_days=0), src, state)


def rau_day_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.rau_day_first_run(CFG_MID, fixture_sources(spark, sf_dir, CFG.tz_offset_hours))


def _from_masks(metric_: Callable, masks: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = fixture_sources(spark, sf_dir, CFG.tz_offset_hours)
        kept = masks(CFG.replace(as_of=datetime.combine(MID_MONTH_START, time())), src)
        return metric_(CFG_MID, src, merge_masks(kept, masks(CFG_MID, src, MID_MONTH_START)))

    return run


def dau_day_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixture_sources(spark, sf_dir, CFG.tz_offset_hours)
    src = src.replace(login=src.login.filter(F.col("login_ts") < ntz(LANDED_UNTIL)))
    newest = src.login.agg(F.max("login_ts").cast("string")).first()[0]  # what the file stream keeps as the log's mark
    cfg = bounded(CFG, ("login",), {(CFG.game_code, "login", UPSTREAM): newest} if newest else {})
    return daily.dau_day(cfg, src)


def _scratch_store(spark: SparkSession) -> TableStore:
    return TableStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/catalog-{uuid.uuid4().hex}")


def sales_day_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixture_sources(spark, sf_dir, CFG.tz_offset_hours)
    store, other = _scratch_store(spark), CFG.replace(game_code=OTHER_GAME)
    unsegmented = src.replace(billing=src.billing.withColumn("os_type", F.when(F.col("member_id") % 3 != 0, F.col("os_type"))))
    old = unsegmented.replace(billing=unsegmented.billing.withColumn("amount", F.col("amount") + 1))  # every sum will differ

    def put(cfg: KpiConfig, rows: DataFrame, cutoff: date) -> None:
        store.replace("sales_day", rows, cfg.game_code, cutoff, SALES_KEYS, "division_date")

    put(CFG, daily.sales_day(CFG, old), CFG.start)
    put(other, daily.sales_day(other, src), CFG.start)
    # the new result holds all days, the range to delete starts mid-month: days before it go by their keys
    put(CFG, daily.sales_day(CFG, unsegmented.replace(billing=unsegmented.billing.filter(F.col("market") != 0))), REPLACE_START)
    return store.read("sales_day")


def rau_week_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixture_sources(spark, sf_dir, CFG.tz_offset_hours)
    store = _scratch_store(spark)
    for game in (CFG.game_code, OTHER_GAME):
        cfg = CFG.replace(game_code=game)
        store.replace("rau_day", daily.rau_day(cfg, src), game, CFG.start, SALES_KEYS[:4], "division_date")
    days = store.read("rau_day", daily.rau_day(CFG, src).schema, game=CFG.game_code, lo=CFG.week_lo, hi=CFG.week_hi)
    return weekly.rau_week(CFG, days)


def sales_day_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixture_sources(spark, sf_dir, CFG.tz_offset_hours)
    path = f"{checkpoint_dir(spark).rstrip('/')}/catalog-{uuid.uuid4().hex}"
    parts = {"yyyy": F.year("log_ts"), "mm": F.month("log_ts")}
    src.billing.withColumns(parts).write.partitionBy(*parts).parquet(path)
    return daily.sales_day(CFG_MID, src.replace(billing=spark.read.parquet(path)))


def bookmarks_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = fixture_sources(spark, sf_dir, CFG.tz_offset_hours)
    nobody = src.replace(tutorial_end=src.tutorial_end.filter("member_id < 0"))  # no tutorial ends: its job finds nothing
    marks = empty_bookmarks(spark)
    for cfg, own in ((CFG.replace(as_of=REPLACE_PRIOR_AS_OF), src), (CFG.replace(game_code=OTHER_GAME, as_of=RU_PRIOR_AS_OF), src), (CFG, nobody)):
        for job, kind, name, col in BOOKMARK_JOBS:
            if name in ("sales_day", "eru_day"):
                marks = advance_bookmark(marks, cfg.game_code, job, kind, metric(name, cfg, own), col)
    return marks


METRICS = [
    "nru_day", "dau_day", "pu_day", "eru_day", "rau_day", "sales_day", "ru_day", "retention_day",
    "nru_week", "wau_week", "pu_week", "eru_week", "rau_week", "sales_week", "sales_week_members",
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: _simple(n) for n in METRICS}
    q["nru_backup_rows"] = _simple("nru_backup_rows")
    q["dau_day_incremental"] = _simple("dau_day", CFG_MID)
    q["pu_day_incremental"] = _simple("pu_day", CFG_MID)
    q["ru_day_incremental"] = ru_day_incremental
    q["ru_day_seeded"] = ru_day_seeded
    q["replace_range"] = replace_range_query
    q["bookmark_advance"] = bookmark_advance
    q["rau_day_stateful"] = rau_day_stateful
    q["rau_day_first_run"] = rau_day_first_run
    q["dau_day_masks"] = _from_masks(daily.dau_day, daily.login_masks)
    q["pu_day_masks"] = _from_masks(daily.pu_day, daily.billing_masks)
    q["dau_day_landed"] = dau_day_landed
    q["sales_day_replaced"] = sales_day_replaced
    q["rau_week_stored"] = rau_week_stored
    q["sales_day_by_month"] = sales_day_by_month
    q["bookmarks_kept"] = bookmarks_kept
    for n in METRICS:
        q[f"{n}_months"] = _simple(n, CFG_SPAN, "orders")
    return {name: _presented(fn) for name, fn in q.items()}


def _presented(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(spark, sf_dir))

    run.__name__ = getattr(fn, "__name__", "query")
    return run


def oracle_statements() -> dict[str, str]:
    s = {n: oracle.statement(n, CFG) for n in METRICS}
    s["nru_backup_rows"] = oracle.statement("nru_backup_rows", CFG)
    s["dau_day_incremental"] = oracle.statement("dau_day", CFG_MID)
    s["pu_day_incremental"] = oracle.statement("pu_day", CFG_MID)
    s["ru_day_incremental"] = oracle.restricted("ru_day", CFG, "division_date", CFG_RU_NEXT.day_lo)
    s["ru_day_seeded"] = oracle.present(
        "ru_day", oracle._with(CFG_RU_NEXT) + oracle.ru_day_body(CFG_RU_NEXT, seed_sql=oracle.ru_day_body(CFG_RU_PRIOR))
    )
    s["replace_range"] = oracle.statement("sales_day", CFG)
    s["bookmark_advance"] = oracle.bookmark_statement(BOOKMARK_JOBS, CFG, CFG)
    s["rau_day_stateful"] = oracle.restricted("rau_day", CFG, "division_date", CFG_MID.day_lo)
    s["rau_day_first_run"] = oracle.statement("rau_day", CFG_MID.replace(rau_lookback_days=0))
    s["dau_day_masks"] = s["dau_day_incremental"]
    s["pu_day_masks"] = s["pu_day_incremental"]
    s["dau_day_landed"] = oracle.landed("dau_day", CFG, "login", "login_ts", LANDED_UNTIL)
    s["sales_day_replaced"] = oracle.sales_replaced(CFG, OTHER_GAME, REPLACE_START)
    s["rau_week_stored"] = oracle.statement("rau_week", CFG)
    s["sales_day_by_month"] = oracle.statement("sales_day", CFG_MID)
    s["bookmarks_kept"] = " UNION ALL ".join(
        [
            oracle.bookmark_statement([("sales", "day", "sales_day", "division_date")], CFG, CFG),
            oracle.bookmark_statement([("eru", "day", "eru_day", "division_date")], CFG.replace(as_of=REPLACE_PRIOR_AS_OF), CFG),
            oracle.bookmark_statement([j for j in BOOKMARK_JOBS if j[2] in ("sales_day", "eru_day")], CFG.replace(game_code=OTHER_GAME, as_of=RU_PRIOR_AS_OF), CFG),
        ]
    )
    for n in METRICS:
        s[f"{n}_months"] = oracle.statement(n, CFG_SPAN, fixture="orders")
    return s
