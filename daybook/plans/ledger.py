"""What is known of each log's days, kept in the store between runs.

* The **ledger** (table ``log_days``) has a row per (game, log, day) that was
  reduced: how many reduced rows it has (0: known to be empty) and whether
  rows have landed for it since (stale). Every log thus has a refresh day of its
  own, which follows from what was reduced and what arrived, not from how far
  some job has come.
* **Upstream marks** (table ``dms``) are bookmarks of that kind, one a log: the
  newest timestamp that has landed. The day of a mark may still be landing, so a report
  bounded by marks ends the day before.

Both are bounded by the calendar, not by the data, so the driver may hold them.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime, time, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from daybook.config import KpiConfig
from daybook.sources.sinks import TableStore

DAY = timedelta(days=1)
TABLE = "log_days"
SCHEMA = T.StructType(
    [
        T.StructField("game_code", T.StringType()),
        T.StructField("log", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("n", T.LongType()),
        T.StructField("stale", T.BooleanType()),
    ]
)
UPSTREAM = "dms"  # table and bookmark kind of upstream marks; the job is the log's name


@dataclass(frozen=True)
class DayState:
    rows: int
    stale: bool = False


Ledger = dict[str, dict[date, DayState]]


def read_ledger(store: TableStore, game_code: str) -> Ledger:
    out: Ledger = {}
    for r in store.read(TABLE, SCHEMA, game=game_code).collect():
        out.setdefault(r["log"], {})[r["day"]] = DayState(r["n"], r["stale"])
    return out


def write_ledger(spark: SparkSession, store: TableStore, game_code: str, ledger: Ledger) -> None:
    rows = [(game_code, log, day, s.rows, s.stale) for log, days in sorted(ledger.items()) for day, s in sorted(days.items())]
    store.replace_game(TABLE, spark.createDataFrame(rows, SCHEMA), game_code)
    store.vacuum(TABLE, keep=2)


def mark_stale(spark: SparkSession, store: TableStore, game_code: str, log: str, lo: date, hi: date) -> None:
    """Rows have landed for the log's days ``lo`` to ``hi``, both included: reduce those known among them again."""
    ledger = read_ledger(store, game_code)
    days = ledger.get(log, {})
    if hit := [d for d, s in days.items() if lo <= d <= hi and not s.stale]:
        ledger[log] = days | {d: replace(days[d], stale=True) for d in hit}
        write_ledger(spark, store, game_code, ledger)


def days_to_reduce(known: dict[date, DayState], lo: date, hi: date, overlap: int, refresh_lo: date | None = None) -> list[date]:
    """Days of ``[lo, hi)`` to reduce from raw rows: those never reduced, stale ones, and the newest ``overlap`` days.

    ``refresh_lo``, where given, stands in for the overlap.
    """
    through = max(known, default=date.min)
    if refresh_lo is None:
        refresh_lo = through - timedelta(days=overlap - 1) if known else date.min
    window = [lo + timedelta(days=k) for k in range((hi - lo).days)]
    return [d for d in window if d >= refresh_lo or d not in known or known[d].stale]


def landed_through(marks: dict[tuple[str, str, str], str], game_code: str, logs: tuple[str, ...]) -> date | None:
    """First day that may still be landing in one of ``logs``; None if a mark is missing for all of them."""
    days = [datetime.fromisoformat(m).date() for log in logs if (m := marks.get((game_code, log, UPSTREAM)))]
    return min(days, default=None)


def bounded(cfg: KpiConfig, logs: tuple[str, ...], marks: dict[tuple[str, str, str], str]) -> KpiConfig:
    """``cfg`` with its report time no later than the start of the first day that may still be landing."""
    first = landed_through(marks, cfg.game_code, logs)
    return cfg if first is None else cfg.replace(as_of=min(cfg.as_of, datetime.combine(first, time())))
