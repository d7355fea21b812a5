"""Calendar expressions: local dates, Sunday weeks, months and window predicates.

All helpers return Column expressions built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen. Window predicates are written on the
*raw* timestamp column against literal bounds, which Catalyst pushes into the
parquet scan (``PushedFilters``) and, where a ``dt`` partition column exists,
turns into partition pruning.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def shift_hours(ts, hours: int) -> Column:
    """``ts + hours`` (timestamp arithmetic; no time-zone rules, like the reference)."""
    if not hours:
        return _c(ts)
    return _c(ts) + F.expr(f"INTERVAL {int(hours)} HOURS")


def local_date(ts, hours: int = 0) -> Column:
    """Calendar date of ``ts`` after shifting it by ``hours``."""
    return F.to_date(shift_hours(ts, hours))


def week_start(d) -> Column:
    """Sunday on or before date ``d`` (Spark ``dayofweek``: 1 = Sunday)."""
    d = _c(d)
    return F.date_sub(d, F.dayofweek(d) - 1)


def month_start(d) -> Column:
    return F.trunc(_c(d), "month")


def _ts(d: date) -> datetime:
    return datetime.combine(d, time())


def ntz(t: datetime) -> Column:
    """A TIMESTAMP_NTZ literal, independent of the session and process time zones."""
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def day_range(ts, lo_exclusive: date, hi_exclusive: date, hours: int = 0) -> Column:
    """Predicate ``lo < local_date(ts, hours) < hi`` expressed on the raw column.

    ``local_date(ts) > lo``  <=>  ``ts >= lo + 1 day - hours``;
    ``local_date(ts) < hi``  <=>  ``ts <  hi - hours``.
    """
    lo_ts = _ts(lo_exclusive + timedelta(days=1)) - timedelta(hours=hours)
    hi_ts = _ts(hi_exclusive) - timedelta(hours=hours)
    c = _c(ts)
    return (c >= ntz(lo_ts)) & (c < ntz(hi_ts))


def day_range_incl(ts, lo_inclusive: date, hi_exclusive: date, hours: int = 0) -> Column:
    """Predicate ``lo <= local_date(ts, hours) < hi`` on the raw column."""
    return day_range(ts, lo_inclusive - timedelta(days=1), hi_exclusive, hours)


def week_range(ts, week_lo_exclusive: date, week_hi_exclusive: date, hours: int = 0) -> Column:
    """Predicate ``wlo < week_start(local_date(ts)) < whi`` for Sunday bounds.

    With Sunday bounds this is ``wlo + 7 <= local_date < whi``.
    """
    return day_range_incl(ts, week_lo_exclusive + timedelta(days=7), week_hi_exclusive, hours)


# Partition layouts of logs by local date: the columns, and their day or month as one number that orders like it.
LAYOUTS: list[tuple[tuple[str, ...], str, str]] = [
    (("dt",), "day", "dt"),
    (("yyyy", "mm", "dd"), "day", "yyyy * 10000 + mm * 100 + dd"),
    (("yyyy", "mm"), "month", "yyyy * 100 + mm"),
    (("ym",), "month", "ym"),
]
LAYOUT_COLUMNS = ("dt", "yyyy", "mm", "dd", "ym")


def partition_range(columns: list[str], lo_inclusive: date, hi_exclusive: date) -> Column | None:
    """Local days ``[lo, hi)`` as a predicate on a table's partition columns alone; None if it has none that is known.

    ``dt`` is a date, ``ym`` a string yyyy-MM, the others are numbers. Month
    layouts keep whole months, so days are filtered on the timestamp as well.
    """
    found = next((x for x in LAYOUTS if set(x[0]) <= set(columns)), None)
    if found is None:
        return None
    (first, *rest), grain, sql = found
    last = hi_exclusive - timedelta(days=1)
    if first == "dt":
        return (F.col("dt") >= F.lit(lo_inclusive)) & (F.col("dt") < F.lit(hi_exclusive))
    if first == "ym":
        return F.col("ym").between(f"{lo_inclusive:%Y-%m}", f"{last:%Y-%m}")
    lo, hi = (d.year * 10000 + d.month * 100 + d.day if grain == "day" else d.year * 100 + d.month for d in (lo_inclusive, last))
    # the bound on the first column alone also prunes where a catalog takes simple comparisons only
    return F.col(first).between(lo_inclusive.year, last.year) & F.expr(sql).between(lo, hi)


def scan_days(df: DataFrame, ts: str, lo_inclusive: date, hi_exclusive: date, hours: int = 0) -> DataFrame:
    """Restrict a log scan to local days ``[lo, hi)``.

    Adds the range on the timestamp column and, when the table carries
    partition columns of a known layout, the same range on them, so whole
    partitions are skipped (only for already-local logs, ``hours == 0``, whose
    partitions are by local date).
    """
    out = df.filter(day_range_incl(ts, lo_inclusive, hi_exclusive, hours))
    parts = partition_range(df.columns, lo_inclusive, hi_exclusive) if hours == 0 else None
    return out if parts is None else out.filter(parts)


def date_sequence(lo_inclusive: date, hi_exclusive: date) -> Column:
    """Array column of every date in ``[lo, hi)`` (empty when hi <= lo)."""
    if hi_exclusive <= lo_inclusive:
        return F.array().cast("array<date>")
    return F.sequence(F.lit(lo_inclusive), F.lit(hi_exclusive - timedelta(days=1)))
