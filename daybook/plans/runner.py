"""Incremental runner: bookmark -> compute -> replace range -> commit -> advance.

One run of ``run_jobs`` does, for each job in order:

1. read the job's bookmark (default: the configured start) and derive its
   windows;
2. compute the metric over the run's shared, reduced logs and stage it in the
   store, partitioned by game and month. The staging job itself observes its
   number of rows and newest date: no checkpoint, and no second pass for the
   guard or the bookmark;
3. skip the job when the result is empty (the reference does the same);
4. add the rows of the touched months that stay (``rows_kept``: neither in the
   recomputed range nor of an equal key) and commit: ``TableStore.replace``;
5. advance the bookmark to the newest date produced, after the write;
6. with ``backup_root`` set, snapshot as CSV the member-level rows behind
   ``nru_day`` (``nru_backup/<start>``) and the ``dau_day`` result
   (``dau_backup/<start>``), overwriting an earlier snapshot of the same start.

Shared reductions: each log is reduced to (member, local day, segment[,
market, product]) grain with a partial aggregate; every metric reads the
reduced tables, whose semantics are exact for all metrics (login keeps the
smallest day sequence, billing and tutorial rows keep their count ``n`` and
money sum). By default a run reduces its whole look-back window from the raw
logs (the reference's semantics under late data); with ``rescan="recent"`` the
reductions persist in the store, partitioned by day, and a run re-reduces only
what the ledger (``plans.ledger``) asks for: days never reduced, days that rows
have landed for since, and each log's newest days; the rest is read back.

Co-location: the reduced logs, ``member`` and ``profile`` are written once per
run as tables bucketed by ``member_id`` into a run folder under the shared
checkpoint directory. Every member-keyed join and member-level distinct of
every metric then reads both sides already partitioned alike and plans no
shuffle for them; the written tables also cut the lineage back to the raw logs.
"""

from __future__ import annotations

import uuid

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.config import KpiConfig
from daybook.functions.calendar import scan_days
from daybook.operators.activity import LOG_ROWS, SEG
from daybook.operators.incremental import BOOKMARK_SCHEMA, bookmark_values, bookmarks_frame
from daybook.operators.last_seen import last_seen
from daybook.operators.month_to_date import LOG_SEG, merge_masks
from daybook.plans import daily, ledger, weekly
from daybook.session import checkpoint_dir
from daybook.sources.sinks import TableStore, backup_csv, delete_path, leaf_partitions, make_folder, month_part, path_exists
from daybook.sources.tables import Sources

DAY = timedelta(days=1)
DAY_KEYS = ["game_code", "division_date", *SEG]
WEEK_KEYS = ["game_code", "division_week", *SEG]
SALES_EXTRA = ["market", "product_idx"]


@dataclass(frozen=True)
class Job:
    name: str  # bookmark job name
    kind: str  # "day" or "week"
    table: str
    compute: Callable[[KpiConfig, Sources, TableStore], DataFrame]
    keys: list[str]
    cutoff: Callable[[KpiConfig], date]  # first date the run recomputes

    @property
    def date_col(self) -> str:
        return self.keys[1]


def _first_day(cfg: KpiConfig) -> date:
    return cfg.day_lo + DAY


def _first_week(cfg: KpiConfig) -> date:
    return cfg.week_lo + timedelta(days=7)


def _ru(cfg: KpiConfig, src: Sources, store: TableStore) -> DataFrame:
    if store.exists("ru_day"):
        return daily.ru_day_incremental(cfg, src, store.read("ru_day", game=cfg.game_code, hi=cfg.day_lo))
    return daily.ru_day(cfg, src)


def _rau_week(cfg: KpiConfig, src: Sources, store: TableStore) -> DataFrame:
    return weekly.rau_week(cfg, store.read("rau_day", daily.rau_day(cfg, src).schema, game=cfg.game_code, lo=_first_week(cfg), hi=cfg.week_hi))


LAST_SEEN, LAST_SEEN_SCHEMA = "last_seen", T.StructType([T.StructField("member_id", T.LongType()), T.StructField("last_day", T.DateType())])


def seen_through(store: TableStore, cfg: KpiConfig) -> date | None:
    """Newest day that the stored last-seen state covers, if it ends before the first report day."""
    days = [date.fromisoformat(p[2:]) for p in store.part_names(LAST_SEEN, cfg.game_code)]
    return max((d for d in days if d <= cfg.day_lo), default=None)


def _rau(cfg: KpiConfig, src: Sources, store: TableStore) -> DataFrame:
    through = seen_through(store, cfg)
    if through is None or cfg.rau_scan_lo != through + DAY:  # the run wasn't set up to go on from the state
        return daily.rau_day(cfg, src)
    return daily.rau_day(cfg, src, store.read_part(LAST_SEEN, LAST_SEEN_SCHEMA, cfg.game_code, f"d-{through}"))


def _keep_last_seen(store: TableStore, cfg: KpiConfig, src: Sources, latest: date) -> None:
    """Store the state up to the day before the next run's first report day, in place of older ones."""
    through, until = seen_through(store, cfg), latest - timedelta(days=cfg.before_days)
    if through is not None and (cfg.rau_scan_lo != through + DAY or until <= through):
        through = None
    if until < cfg.rau_scan_lo:
        return
    state = None if through is None else store.read_part(LAST_SEEN, LAST_SEEN_SCHEMA, cfg.game_code, f"d-{through}")
    days = daily.first_login_days(cfg, src, cfg.rau_scan_lo, until + DAY)
    store.replace_game(LAST_SEEN, last_seen(days, state), cfg.game_code, f"d-{until}", few=False)
    for part in store.part_names(LAST_SEEN, cfg.game_code) - {f"d-{until}"}:
        store.drop_part(LAST_SEEN, cfg.game_code, part)


def _m(fn):
    return lambda cfg, src, store: fn(cfg, src)


DAILY_JOBS = [
    Job("nru", "day", "nru_day", _m(daily.nru_day), DAY_KEYS, _first_day),
    Job("dau", "day", "dau_day", _m(daily.dau_day), DAY_KEYS, _first_day),
    Job("pu", "day", "pu_day", _m(daily.pu_day), DAY_KEYS, _first_day),
    Job("eru", "day", "eru_day", _m(daily.eru_day), DAY_KEYS, _first_day),
    Job("rau", "day", "rau_day", _rau, DAY_KEYS, _first_day),
    Job("sales", "day", "sales_day", _m(daily.sales_day), DAY_KEYS + SALES_EXTRA, _first_day),
    Job("ru", "day", "ru_day", _ru, DAY_KEYS, _first_day),
    Job("retention", "day", "retention_day", _m(daily.retention_day), DAY_KEYS, lambda c: c.retention_day_lo + DAY),
]
WEEKLY_JOBS = [
    Job("nru", "week", "nru_week", _m(weekly.nru_week), WEEK_KEYS, _first_week),
    Job("wau", "week", "wau_week", _m(weekly.wau_week), WEEK_KEYS, _first_week),
    Job("pu", "week", "pu_week", _m(weekly.pu_week), WEEK_KEYS, _first_week),
    Job("eru", "week", "eru_week", _m(weekly.eru_week), WEEK_KEYS, _first_week),
    Job("rau", "week", "rau_week", _rau_week, WEEK_KEYS, _first_week),
    Job("sales", "week", "sales_week", _m(weekly.sales_week), WEEK_KEYS + SALES_EXTRA, _first_week),
]


LOG_TS = {"login": "login_ts", "billing": "log_ts", "tutorial_end": "log_ts"}


def reduce_log(name: str, df: DataFrame, lo_inclusive: date, hi_exclusive: date) -> DataFrame:
    """One log over local days ``[lo, hi)`` at member-day grain (partial aggregate)."""
    ts = LOG_TS[name]
    rows = scan_days(df, ts, lo_inclusive, hi_exclusive)
    day_ts = F.col("dt").cast("timestamp_ntz").alias(ts)
    dt = F.to_date(ts).alias("dt")
    if name == "login":
        return (
            rows.groupBy("member_id", dt, *SEG)
            .agg(F.min("login_day_seq").alias("login_day_seq"), F.count(F.lit(1)).alias(LOG_ROWS))
            .select("member_id", day_ts, *SEG, "login_day_seq", LOG_ROWS, "dt")
        )
    if name == "billing":
        return (
            rows.groupBy("member_id", dt, *SEG, "market", "product_id")
            .agg(F.count(F.lit(1)).alias(LOG_ROWS), F.sum("amount").alias("amount"))
            .select("member_id", day_ts, *SEG, "market", "product_id", "amount", LOG_ROWS, "dt")
        )
    return (
        rows.groupBy("member_id", dt, *SEG)
        .agg(F.count(F.lit(1)).alias(LOG_ROWS))
        .select("member_id", day_ts, *SEG, LOG_ROWS, "dt")
    )


def reduce_logs(src: Sources, lo_inclusive: date | dict[str, date], hi_exclusive: date) -> Sources:
    """The three logs over local days ``[lo, hi)`` at member-day grain; ``lo`` may differ by log."""
    lo = lo_inclusive if isinstance(lo_inclusive, dict) else dict.fromkeys(LOG_TS, lo_inclusive)
    return src.replace(**{name: reduce_log(name, getattr(src, name), lo.get(name, hi_exclusive), hi_exclusive) for name in LOG_TS})


# The logs that a table's job reads, and the first local day of them that it needs.
LOG_READS: dict[str, tuple[tuple[str, ...], Callable[[KpiConfig], date]]] = {
    "dau_day": (("login",), lambda c: c.month_lo),
    "pu_day": (("billing",), lambda c: c.month_lo),
    "eru_day": (("tutorial_end",), lambda c: c.day_lo + DAY),
    "rau_day": (("login",), lambda c: min(c.rau_scan_lo, c.day_lo + DAY)),
    "sales_day": (("billing",), lambda c: c.day_lo + DAY),
    "retention_day": (("login", "billing"), lambda c: c.retention_day_lo + DAY),
    "wau_week": (("login",), lambda c: c.week_lo + timedelta(days=7)),
    "pu_week": (("billing",), lambda c: c.week_lo + timedelta(days=7)),
    "eru_week": (("tutorial_end",), lambda c: c.week_lo + timedelta(days=7)),
    "sales_week": (("billing",), lambda c: c.week_lo + timedelta(days=7)),
}


def log_windows(jobs: list[Job], cfgs: dict[str, KpiConfig]) -> dict[str, date]:
    """Per log the first local day that any of ``jobs`` reads; logs that none reads are left out."""
    lows: dict[str, date] = {}
    for job in jobs:
        logs, first = LOG_READS.get(job.table, ((), None))
        for log in logs:
            lows[log] = min(lows.get(log, date.max), first(cfgs[job.table]))
    return lows


def refresh_reductions(
    spark: SparkSession,
    store: TableStore,
    src: Sources,
    game_code: str,
    lo: date | dict[str, date],
    hi: date,
    refresh_lo: date | None = None,
    overlap: int = 1,
    reduced: dict[str, list[date]] | None = None,
) -> Sources:
    """The reduced logs for days ``[lo, hi)`` (``lo`` may differ by log), kept in the store between runs.

    Each log's reduction is a table partitioned by ``dt``; the ledger says which
    days to reduce anew (``ledger.days_to_reduce``). They are staged whole and
    then swapped in, so readers see the old days until the new ones are there. A
    day that has lost all its raw rows becomes empty if the log still holds
    rows of that day or an earlier one; if not, the raw day has expired and what
    was stored of it stays. ``reduced``, where given, gets each log's days that
    were reduced.
    """
    known = ledger.read_ledger(store, game_code)
    lows = lo if isinstance(lo, dict) else dict.fromkeys(LOG_TS, lo)
    frames, changed = {}, False
    for name, ts in LOG_TS.items():
        first = lows.get(name, hi)
        table, raw = f"_reduced/{game_code}/{name}", getattr(src, name)
        days = known.setdefault(name, {})
        todo = ledger.days_to_reduce(days, first, hi, overlap, refresh_lo)
        part = reduce_log(name, raw, min(todo, default=first), max(todo, default=first - DAY) + DAY)
        if todo:
            if len(todo) != (max(todo) - min(todo)).days + 1:
                part = part.filter(F.col("dt").isin(todo))
            staged = store.staging(table)
            part.hint("rebalance", "dt").write.partitionBy("dt").parquet(staged)
            found = {date.fromisoformat(p[-10:]) for p in leaf_partitions(spark, staged)}
            lost = [d for d in todo if d not in found and d in days and days[d].rows]
            if lost:  # rare: only then the log's oldest row is looked for
                oldest = raw.agg(F.min(F.to_date(ts))).first()[0]
                lost = [d for d in lost if oldest is not None and oldest <= d]
            for d in lost:
                make_folder(spark, f"{staged}/dt={d.isoformat()}")
            store.swap(table, staged)
            store.vacuum(table, keep=1)
            counts = {}
            if found:
                new = spark.read.schema(part.schema).parquet(store.parts(table)).filter(F.col("dt").isin(sorted(found)))
                counts = {r["dt"]: r["count"] for r in new.groupBy("dt").count().collect()}  # a row a day
            for d in todo:
                kept = d not in found and d not in lost and d in days
                days[d] = ledger.DayState(days[d].rows if kept else counts.get(d, 0))
            changed = True
        if reduced is not None:
            reduced[name] = todo
        there = path_exists(spark, store.parts(table))
        stored = spark.read.schema(part.schema).parquet(store.parts(table)) if there else spark.createDataFrame([], part.schema)
        frames[name] = stored.filter((F.col("dt") >= F.lit(first)) & (F.col("dt") < F.lit(hi)))
    if changed:
        ledger.write_ledger(spark, store, game_code, known)
    return src.replace(**frames)


MASKS = {"login": ("dau_day", daily.login_masks, LOG_SEG), "billing": ("pu_day", daily.billing_masks, [])}


def _mask_schema(seg: list[str]) -> T.StructType:
    types = {"l_os_type": T.IntegerType(), "l_country_code": T.StringType()}
    fields = [("member_id", T.LongType()), ("month", T.DateType()), *((c, types[c]) for c in seg), ("days", T.IntegerType())]
    return T.StructType([T.StructField(n, t) for n, t in fields])


def refresh_masks(store: TableStore, src: Sources, cfgs: dict[str, KpiConfig], reduced: dict[str, list[date]]) -> dict[str, DataFrame]:
    """The month masks behind ``dau_day`` and ``pu_day`` over their month windows, kept in the store between runs.

    A month's masks are a part of their table. A run reads only the days that
    were reduced anew: it drops what the stored masks say of these and merges
    the rest with the new bits; other months' parts stay untouched.
    """
    out = {}
    for log, (table, masks, seg) in MASKS.items():
        if table not in cfgs:
            return {}
        cfg, name, schema = cfgs[table], f"{log}_masks", _mask_schema(seg)
        parts = store.part_names(name, cfg.game_code)
        days = [cfg.month_lo + timedelta(days=k) for k in range((cfg.day_hi - cfg.month_lo).days)]
        months = sorted({d.replace(day=1) for d in days})
        for month in months:
            own = [d for d in days if d.replace(day=1) == month]
            new = own if month_part(month) not in parts else sorted(set(own) & set(reduced.get(log, [])))
            if not new:
                continue
            rows = masks(cfg.replace(as_of=datetime.combine(new[-1] + DAY, time())), src, new[0])
            if len(new) < (new[-1] - new[0]).days + 1:  # days in between that were not reduced anew are read, too
                new = [new[0] + timedelta(days=k) for k in range((new[-1] - new[0]).days + 1)]
            if month_part(month) in parts:
                old = store.read_part(name, schema, cfg.game_code, month_part(month))
                rows = merge_masks(old, rows, sum(1 << (d.day - 1) for d in new))
            store.replace_game(name, rows.select([f.name for f in schema]), cfg.game_code, month_part(month), few=False)
        store.vacuum(name, keep=1)
        out[log] = reduce(DataFrame.unionByName, [store.read_part(name, schema, cfg.game_code, month_part(m)) for m in months])
    return out


def job_config(base: KpiConfig, job: Job, marks: dict[tuple[str, str, str], str]) -> KpiConfig:
    default = base.start if job.kind == "day" else base.week_start
    mark = marks.get((base.game_code, job.name, job.kind)) or default.isoformat()
    return base.replace(start=mark) if job.kind == "day" else base.replace(week_start=mark)


def scan_window(cfgs: list[KpiConfig]) -> tuple[date, date]:
    lo = min(
        min(c.month_lo, c.rau_scan_lo, c.retention_day_lo + DAY, c.day_lo + DAY, c.week_lo + timedelta(days=7))
        for c in cfgs
    )
    hi = max(c.day_hi for c in cfgs)
    return lo, hi


# What is kept of a job's run, from the sources or from the rows that it committed.
BACKUPS: dict[str, Callable[[KpiConfig, Sources, DataFrame], DataFrame]] = {
    "nru_day": lambda cfg, src, result: daily.nru_backup_rows(cfg, src),
    "dau_day": lambda cfg, src, result: result,
}


def _drop_work(spark: SparkSession, tables: list[str], folder: str) -> None:
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    delete_path(spark, folder)


def colocate(spark: SparkSession, src: Sources, work_root: str, buckets: int) -> tuple[Sources, list[str], str]:
    """Write every source as a table bucketed by ``member_id``; read them back.

    Rows are hash-partitioned into ``buckets`` first, so each task writes one
    bucket file. Logs must already be reduced (a hot member then reaches the
    shuffle as a few pre-aggregated rows). Returns the sources, the table
    names and the run folder (for clean-up).
    """
    run_id = uuid.uuid4().hex[:12]
    folder = f"{work_root.rstrip('/')}/{run_id}"
    frames, tables = {}, []
    try:
        for name, df in src.items():
            table = f"daybook_work_{run_id}_{name}"
            tables.append(table)
            (
                df.repartition(buckets, "member_id")
                .write.bucketBy(buckets, "member_id")
                .option("path", f"{folder}/{name}")
                .mode("errorifexists")
                .saveAsTable(table)
            )
            frames[name] = spark.table(table)
    except BaseException:
        _drop_work(spark, tables, folder)
        raise
    return Sources(**frames, colocated=True), tables, folder


# Job-level session settings, restored after the run. The co-located tables
# are partitioned by member_id alone; joins on (member_id, day) may use that
# partitioning because every member reaches it reduced to at most days x
# segments rows, so the skew guard of requiring all join keys is not needed.
RUN_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def run_jobs(
    spark: SparkSession,
    store: TableStore,
    src: Sources,
    base: KpiConfig,
    jobs: list[Job],
    backup_root: str | None = None,
    buckets: int | None = None,
    keep_versions: int | None = None,
    rescan: str = "window",
    landed_only: bool = False,
) -> dict[str, str | None]:
    """Run ``jobs`` in order; returns job table -> new bookmark (None if skipped).

    ``buckets`` sets the co-location bucket count (default: the session's
    ``spark.sql.shuffle.partitions``); ``keep_versions`` bounds the versions
    kept per table (None keeps all). The run's work tables are dropped and
    their folder deleted at the end, also after a failure.

    ``rescan`` chooses how much raw log a run reads:

    * ``"window"`` (default): every day of the run's look-back window is
      reduced from the raw logs, so every result reflects all rows present
      when the run starts, late ones included -- the reference's semantics;
    * ``"recent"``: reductions persist in the store; a run re-reduces days never
      reduced, each log's newest ``before_days`` reduced days, and days that the
      ledger calls stale because rows have landed for them
      (``streaming.refresh`` marks these, and rewinds bookmarks).

    With ``landed_only`` a job reports only days before the one that the upstream
    marks of its logs name, which may still be landing.
    """
    if rescan not in ("window", "recent"):
        raise ValueError("rescan must be 'window' or 'recent'")
    ckpt = checkpoint_dir(spark)
    marks = bookmark_values(store.read("bookmark", BOOKMARK_SCHEMA, game=base.game_code))
    cfgs = {job.table: job_config(base, job, marks) for job in jobs}
    if landed_only:
        landed = bookmark_values(store.read(ledger.UPSTREAM, BOOKMARK_SCHEMA, game=base.game_code))
        cfgs = {t: ledger.bounded(c, LOG_READS.get(t, ((), None))[0], landed) for t, c in cfgs.items()}
    if rescan == "recent" and "rau_day" in cfgs and (through := seen_through(store, cfgs["rau_day"])) is not None:
        cfg = cfgs["rau_day"]  # only days after the state are read
        cfgs["rau_day"] = cfg.replace(rau_lookback_days=(cfg.day_lo - through).days)
    lows, hi = log_windows(jobs, cfgs), max(c.day_hi for c in cfgs.values())
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with session_conf(spark, RUN_CONF):
        if rescan == "recent":
            anew: dict[str, list[date]] = {}
            logs = refresh_reductions(spark, store, src, base.game_code, lows, hi, overlap=base.before_days, reduced=anew)
            masks = refresh_masks(store, logs, cfgs, anew)
        else:
            logs = reduce_logs(src, lows, hi)
        reduced, work_tables, work_folder = colocate(spark, logs, f"{ckpt}/daybook-work", n)
        try:
            out = _run(spark, store, reduced.replace(masks=masks or None) if rescan == "recent" else reduced, cfgs, jobs, backup_root)
            if rescan == "recent" and "rau_day" in cfgs:
                cfg = cfgs["rau_day"]
                _keep_last_seen(store, cfg, reduced, date.fromisoformat(out["rau_day"] or cfg.start.isoformat()))
        finally:
            _drop_work(spark, work_tables, work_folder)
    if keep_versions:
        for table in [job.table for job in jobs] + ["bookmark"]:
            store.vacuum(table, keep_versions)
    return out


def _run(spark, store, reduced, cfgs, jobs, backup_root) -> dict[str, str | None]:
    out: dict[str, str | None] = {}
    for job in jobs:
        cfg = cfgs[job.table]
        result = job.compute(cfg, reduced, store)
        landed = store.replace(job.table, result, cfg.game_code, job.cutoff(cfg), job.keys, job.date_col)
        out[job.table] = landed.latest.isoformat() if landed else None
        if landed is None:
            continue
        # the bookmark moves only after the table's commit; a game's marks are a partition of their own
        marks = bookmark_values(store.read("bookmark", BOOKMARK_SCHEMA, game=cfg.game_code))
        marks[cfg.game_code, job.name, job.kind] = landed.latest.isoformat()
        store.replace_game("bookmark", bookmarks_frame(spark, marks), cfg.game_code)
        if backup_root and job.table in BACKUPS:
            folder, first = job.table.split("_")[0], job.cutoff(cfg)
            rows = store.read(job.table, result.schema, game=cfg.game_code, lo=first).filter(F.col(job.date_col) >= F.lit(first))
            backup_csv(BACKUPS[job.table](cfg, reduced, rows), f"{backup_root.rstrip('/')}/{folder}_backup/{cfg.start.isoformat()}")
    return out


def run_daily(
    spark: SparkSession,
    store: TableStore,
    src: Sources,
    base: KpiConfig,
    backup_root: str | None = None,
    buckets: int | None = None,
    keep_versions: int | None = None,
    rescan: str = "window",
    landed_only: bool = False,
) -> dict[str, str | None]:
    return run_jobs(spark, store, src, base, DAILY_JOBS, backup_root, buckets, keep_versions, rescan, landed_only)


def run_weekly(
    spark: SparkSession,
    store: TableStore,
    src: Sources,
    base: KpiConfig,
    buckets: int | None = None,
    keep_versions: int | None = None,
    rescan: str = "window",
    landed_only: bool = False,
) -> dict[str, str | None]:
    return run_jobs(spark, store, src, base, WEEKLY_JOBS, buckets=buckets, keep_versions=keep_versions, rescan=rescan, landed_only=landed_only)
