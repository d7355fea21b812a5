"""Run configuration and the driver-side date arithmetic derived from it.

Everything here is scalar work on the driver (a handful of dates); no data
passes through it. The windows follow the reference jobs:

* daily report days ``d``: ``start - before_days < d < as_of.date()``
  (both bounds exclusive);
* month-to-date look-back: from the first day of the month of
  ``start - before_days``;
* weekly report weeks ``w`` (Sunday starts): ``week(start) < w < week(as_of)``;
* retention cohorts: the daily window, opened ``retention_lookback_days``
  earlier;
* returning users: the lag look-back begins ``rau_lookback_days`` before the
  first report day, enough to see the whole 7-day gap of every report day.
"""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass
from datetime import date, datetime, timedelta


def sunday_week_start(d: date) -> date:
    """Sunday on or before ``d`` (weeks run Sunday..Saturday)."""
    # date.weekday(): Monday=0 .. Sunday=6  ->  days since Sunday
    return d - timedelta(days=(d.weekday() + 1) % 7)


def month_start(d: date) -> date:
    return d.replace(day=1)


def _as_date(v) -> date:
    if isinstance(v, datetime):
        return v.date()
    if isinstance(v, date):
        return v
    return date.fromisoformat(str(v).split(" ", 1)[0].split(".", 1)[0])


def _as_datetime(v) -> datetime:
    if isinstance(v, datetime):
        return v
    if isinstance(v, date):
        return datetime(v.year, v.month, v.day)
    return datetime.fromisoformat(str(v).split(".", 1)[0])


@dataclass(frozen=True)
class KpiConfig:
    """Parameters of one run.

    ``start`` is the daily bookmark, ``week_start`` the weekly bookmark and
    ``as_of`` the local report time that replaces ``now()``.
    ``tz_offset_hours`` converts the UTC registration time of members to local
    time; log timestamps are already local.
    """

    game_code: str = "game01"
    tz_offset_hours: int = 9
    before_days: int = 1
    start: date = date(2024, 1, 1)
    week_start: date = date(2023, 12, 24)
    as_of: datetime = datetime(2024, 1, 31)
    retention_lookback_days: int = 32
    rau_lookback_days: int | None = None

    def __post_init__(self):
        object.__setattr__(self, "start", _as_date(self.start))
        object.__setattr__(self, "week_start", _as_date(self.week_start))
        object.__setattr__(self, "as_of", _as_datetime(self.as_of))

    def replace(self, **kw) -> "KpiConfig":
        return dataclasses.replace(self, **kw)

    # ---- daily window -------------------------------------------------
    @property
    def day_lo(self) -> date:
        """Exclusive lower bound of daily report days (``start - before_days``)."""
        return self.start - timedelta(days=self.before_days)

    @property
    def day_hi(self) -> date:
        """Exclusive upper bound of report days (the local date of ``as_of``)."""
        return self.as_of.date()

    @property
    def month_lo(self) -> date:
        """Inclusive lower bound of the month-to-date scan."""
        return month_start(self.day_lo)

    # ---- weekly window ------------------------------------------------
    @property
    def week_lo(self) -> date:
        """Exclusive lower bound on week starts (the bookmark's own week)."""
        return sunday_week_start(self.week_start)

    @property
    def week_hi(self) -> date:
        """Exclusive upper bound on week starts (the current, unfinished week)."""
        return sunday_week_start(self.as_of.date())

    # ---- look-backs ---------------------------------------------------
    @property
    def retention_day_lo(self) -> date:
        """Exclusive lower bound of retention cohort days."""
        return self.day_lo - timedelta(days=self.retention_lookback_days)

    @property
    def rau_scan_lo(self) -> date:
        """Inclusive first login day the returning-user lag can see."""
        back = self.rau_lookback_days
        if back is None:
            back = 7
        # first report day is day_lo + 1; its gap window starts 7 days earlier
        return self.day_lo + timedelta(days=1) - timedelta(days=back)

    def first_run(self) -> "KpiConfig":
        """The variant in which the returning-user lag sees no login before the bookmark."""
        return self.replace(rau_lookback_days=1 - self.before_days)


# Fixed values of the checked scenario (FIXTURES.md section 3): local offset 9 h,
# one day of overlap, daily bookmark 2024-01-01, weekly bookmark 2023-12-24,
# report time 2024-01-31 00:00 local.
FIXTURE_CONFIG = KpiConfig(
    game_code="game01",
    tz_offset_hours=9,
    before_days=1,
    start=date(2024, 1, 1),
    week_start=date(2023, 12, 24),
    as_of=datetime(2024, 1, 31, 0, 0),
)
